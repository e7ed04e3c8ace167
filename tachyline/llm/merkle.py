"""Merkle fingerprints of documents, with DataFrame functions only.

The lines of a text are its sections and their sentences its paragraphs. A leaf is the SHA-256 of a paragraph, a
section the SHA-256 of its leaves' digests, the root the SHA-256 of its sections' digests. Cutting is reversible, so
texts are equal if and only if their roots are (but for collisions of SHA-256). A fingerprint is the root, then each
section with its leaves: ``root/section=leaf.length-leaf.length/...``, with digests of 12 hexadecimal digits below
the root. Branches that differ locate an edit; the length of the paragraphs that two fingerprints share, by the
length of all in the longer one, is their likeness.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Neighbouring documents are found in ranges of doc_id of about this many rows, 256 * 256 ranges at most; one row for
#: each range is broadcast. The ranges' bounds come from a sample of identifiers, as in Spark's own range partitioning:
#: they only decide which task has which rows.
RANGE_ROWS, STEPS, SAMPLE = 2048, 256, 1_000_000


def tree(text: Column) -> Column:
    """Sections of leaves: array of (digest, leaves), a leaf being ``digest12.length``."""
    cut = F.regexp_replace(text, "([.!?]) ", "$1 \u0001")
    return F.transform(
        F.split(cut, "\n", -1),
        lambda line: F.transform(F.split(line, "\u0001", -1), lambda p: F.struct(F.sha2(p, 256).alias("digest"), F.char_length(p).alias("n"))),
    )


def sections(leaves: Column) -> Column:
    """Digest of each section of a ``tree``."""
    return F.transform(leaves, lambda s: F.sha2(F.array_join(F.transform(s, lambda x: x["digest"]), ""), 256))


def fingerprint(leaves: Column, digests: Column) -> Column:
    named = F.zip_with(digests, leaves, lambda d, s: F.concat(F.substring(d, 1, 12), F.lit("="), F.array_join(F.transform(s, lambda x: F.concat(F.substring(x["digest"], 1, 12), F.lit("."), x["n"])), "-")))
    return F.concat(F.sha2(F.array_join(digests, ""), 256), F.lit("/"), F.array_join(named, "/"))


def paragraphs(mark: Column) -> Column:
    """The distinct leaves, ``digest12.length``, of a fingerprint."""
    return F.array_distinct(F.split(F.regexp_replace(F.substring(mark, 66, 2**31 - 1), "(^|/)[0-9a-f]{12}=", "-"), "-"))


def _length(leaves: Column) -> Column:
    return F.aggregate(leaves, F.lit(0).cast("long"), lambda total, x: total + F.coalesce(F.substring_index(x, ".", -1).try_cast("long"), F.lit(0)))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1, from the ``paragraphs`` of two fingerprints; 1 if both are of empty texts."""
    shared, most = _length(F.array_intersect(a, b)), F.greatest(_length(a), _length(b))
    return F.when(most == 0, 1.0).otherwise(shared / most)


def edited_sections(a: Column, b: Column) -> Column:
    """Numbers (from 1) of the sections in which two fingerprints differ, sections that only one has included."""
    left, right = (F.split(F.substring(x, 66, 2**31 - 1), "/") for x in (a, b))
    return F.filter(F.sequence(F.lit(1), F.greatest(F.size(left), F.size(right))), lambda k: ~F.get(left, k - 1).eqNullSafe(F.get(right, k - 1)))


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of column ``text``, null as empty. A column already named ``name`` is replaced."""
    own = docs.withColumn("__tree", tree(F.coalesce(text, F.lit("")))).withColumn("__sections", sections(F.col("__tree")))
    return own.withColumn(name, fingerprint(F.col("__tree"), F.col("__sections"))).drop("__tree", "__sections")


def ranges(docs: DataFrame) -> list[int]:
    """Lower bounds, ascending, of ranges of doc_id with about ``RANGE_ROWS`` rows each; the first range has none."""
    ids = docs.where("doc_id is not null").select("doc_id")
    rows = ids.count()
    parts = min(STEPS * STEPS, rows // RANGE_ROWS)
    if parts < 2:
        return []
    share = F.array(*(F.lit(k / parts) for k in range(1, parts)))
    drawn = ids.sample(min(1.0, SAMPLE / rows), 7) if rows > SAMPLE else ids
    return sorted(set(drawn.agg(F.percentile_approx("doc_id", share, 4 * parts)).first()[0] or []))


def range_of(bounds: list[int]) -> Column:
    """The number of the range that a doc_id is in, found in two steps over a constant table."""
    if not bounds:
        return F.lit(0)
    rows = [bounds[k : k + STEPS] for k in range(0, len(bounds), STEPS)]
    table = F.array(*(F.array(*(F.lit(x).cast("long") for x in row)) for row in rows))
    heads = F.array(*(F.lit(row[0]).cast("long") for row in rows))
    row = F.size(F.filter(heads, lambda x: x <= F.col("doc_id")))
    inside = F.size(F.filter(F.get(table, row - 1), lambda x: x <= F.col("doc_id")))
    return F.when(row == 0, 0).otherwise((row - 1) * STEPS + inside)


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, fingerprint, next_text and next_fingerprint: those of the next row in descending doc_id; after the
    last comes the first.

    Rows that share a doc_id come in the order of their texts. Each range of identifiers is sorted on its own; the
    top rows of a range also stand, as guests, at the end of the range that comes before it. Fingerprints are made
    where the rows have arrived, once for each.
    """
    rows = docs.where("doc_id is not null").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    part = range_of(ranges(docs)).alias("part")
    tops = docs.where("doc_id is not null").groupBy(part).agg(F.max("doc_id").alias("doc_id"))
    order = Window.orderBy("part")  # one row for each range
    hosts = tops.select("doc_id", F.coalesce(F.lead("part").over(order), F.min("part").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("part"))
    guests = rows.join(F.broadcast(hosts), "doc_id").select("part", F.lit(1).alias("guest"), "doc_id", "text")  # one doc_id for each range
    both = rows.select(part, F.lit(0).alias("guest"), "doc_id", "text").unionByName(guests).repartition("part")
    own = Window.partitionBy("part").orderBy("guest", F.desc("doc_id"), "text")
    both = with_fingerprint(both).withColumn("next", F.lead(F.struct("text", "fingerprint")).over(own))
    return both.where("guest = 0").select("doc_id", "text", "fingerprint", F.col("next.text").alias("next_text"), F.col("next.fingerprint").alias("next_fingerprint"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) -> doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, edited_at.

    The edited text has its last floor(n_chars / 2) code points replaced by as many first ones (or all) of the next
    document's, in descending doc_id. ``edited_at`` numbers the sections that the edit changed. Null text is empty;
    rows without doc_id aren't returned; repeated rows follow one another; a single document follows itself. Other
    columns are ignored.
    """
    n = F.char_length("text")
    rows = with_next(docs).withColumn("n_chars", n.cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half)))
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    rows = with_fingerprint(rows, "edited", "edited_fingerprint")
    for name in ("fingerprint", "edited_fingerprint", "next_fingerprint"):
        rows = rows.withColumn(f"__{name}", paragraphs(F.col(name)))
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", likeness(F.col("__fingerprint"), F.col("__edited_fingerprint")).alias("near_edited"), likeness(F.col("__fingerprint"), F.col("__next_fingerprint")).alias("near_next"), edited_sections(F.col("fingerprint"), F.col("edited_fingerprint")).alias("edited_at"))


def op4_merkle_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    return edited_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("edited_at")


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents WHERE doc_id IS NOT NULL),
x AS (SELECT doc_id, t, length(t) AS n, coalesce(lead(t) OVER o, first(t) OVER (ORDER BY doc_id DESC, t ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS u FROM d WINDOW o AS (ORDER BY doc_id DESC, t)),
y AS (SELECT doc_id, n, t, u, left(t, n - n//2) || left(u, n//2) AS e FROM x),
z AS (SELECT doc_id, n, sha256(e) AS es, unnest(['t', 'e', 'u']) AS k, unnest([t, e, u]) AS s FROM y),
l AS (SELECT doc_id, n, es, k, list_transform(string_split(regexp_replace(s, '([.!?]) ', '\1 ' || chr(1), 'g'), chr(10)),
    lambda line: list_transform(string_split(line, chr(1)), lambda p: {'d': sha256(p), 'n': length(p)})) AS tree FROM z),
f AS (SELECT doc_id, n, es, k, list_transform(tree, lambda q: sha256(array_to_string(list_transform(q, lambda v: v.d), ''))) AS ds, tree,
    list_distinct(list_transform(flatten(tree), lambda v: left(v.d, 12) || '.' || v.n)) AS ps FROM l),
m AS (SELECT doc_id, n, es, k, ps, sha256(array_to_string(ds, '')) || '/' || array_to_string(list_transform(range(1, len(ds) + 1), lambda i: left(ds[i], 12) || '=' ||
    array_to_string(list_transform(tree[i], lambda v: left(v.d, 12) || '.' || v.n), '-')), '/') AS mark FROM f),
w AS (SELECT doc_id, k, mark, ps, es, n, coalesce(list_sum(list_transform(ps, lambda v: string_split(v, '.')[2]::BIGINT)), 0) AS total FROM m)
SELECT a.doc_id, a.n::BIGINT AS n_chars, a.es AS edited_sha256, a.mark AS fingerprint, b.mark AS edited_fingerprint,
  CASE WHEN greatest(a.total, b.total) = 0 THEN 1.0::DOUBLE ELSE coalesce(list_sum(list_transform(list_intersect(a.ps, b.ps), lambda v: string_split(v, '.')[2]::BIGINT)), 0)::DOUBLE / greatest(a.total, b.total) END AS near_edited,
  CASE WHEN greatest(a.total, c.total) = 0 THEN 1.0::DOUBLE ELSE coalesce(list_sum(list_transform(list_intersect(a.ps, c.ps), lambda v: string_split(v, '.')[2]::BIGINT)), 0)::DOUBLE / greatest(a.total, c.total) END AS near_next
FROM w a JOIN w b ON b.doc_id = a.doc_id AND b.k = 'e' JOIN w c ON c.doc_id = a.doc_id AND c.k = 'u' WHERE a.k = 't'
"""
