"""Token files, dataset manifest and prefix trie against brute force, round trips and awkward tables."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tachyline.llm import common, manifest, prefix_trie, token_store, word_pieces
from tachyline.llm.word_pieces import WordEncoder

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["part", "serial", "row", "tie", "at", "first", "start", "before", "grp", "id", "digest", "other", "pos", "words", "depth", "fp", "rep", "up", "label"]
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def clashing(spark, rows, schema):
    return spark.createDataFrame([(*r, *(["c"] * len(CLASH))) for r in rows], schema + "".join(f", `{c}` string" for c in CLASH))


# Token files


def test_words_give_the_identifiers_of_whole_texts():
    rng, encoder = random.Random(3), WordEncoder(PATH)
    signs = ["a", "B", " ", "\n", "\x85", "\xa0", "'s", "'LL", "<|endoftext|>", "İ", "Σ", "ς", "日本", "é", "́", "½", "9", "!", "...", "_", "\x00", "\x1c", "ſ", "Ÿ", "😀", "​", "ŉ", "K", "Ⱥ"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    want = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert all(encoder.encode(t).tolist() == w.ids for t, w in zip(texts, want, strict=True))


def test_long_text_and_full_dictionaries(monkeypatch):
    monkeypatch.setattr("tachyline.llm.word_pieces.SEGMENT", 50)
    monkeypatch.setattr("tachyline.llm.word_pieces.WORDS", 20)
    monkeypatch.setattr("tachyline.llm.word_pieces.PIECES", 10)
    rng, encoder = random.Random(4), WordEncoder(PATH)
    text = " ".join("".join(rng.choice("abcéB,.") for _ in range(rng.randint(1, 9))) for _ in range(5000)) + "x" * 3000
    assert encoder.encode(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_rows_are_encoded_together_and_each_word_once(monkeypatch):
    """Words around 16 bytes, words that end in NUL, more of them than the first tables hold, and the old number of places."""
    rng, encoder = random.Random(6), WordEncoder(PATH)
    rows = [" ".join("".join(rng.choice("aB,\x00é日") for _ in range(rng.choice([1, 2, 7, 8, 9, 14, 15, 16, 17, 40]))) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    rows += ["", None, "a", "a\x00", "a\x00\x00", "<|endoftext|>", rows[0]]
    data, offsets = common.texts_of(pa.array(rows))
    want = [x.ids for x in encoder.tokenizer.encode_batch([r or "" for r in rows], add_special_tokens=False)]
    learnt, learn = [], encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda words: (learnt.extend(words), learn(words)))
    for _ in range(2):
        ids, counts = encoder.rows(data, offsets)
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want
    assert len(learnt) > 1 << 11 and len(learnt) == len({w for r in rows for w in (r or "").encode().split()}) == encoder.ids.n
    assert word_pieces.WORDS > 1 << 20


@pytest.mark.parametrize("most", [1, 16, 256, 300, 49408, 2**32])
def test_codes_give_any_identifier_by_its_place(most):
    rng = np.random.default_rng(most % 1000)
    for n in (0, 1, 511, 512, 513, 5000):
        ids = (rng.random(n) ** 4 * most).astype(np.uint32)
        codes = token_store.Codes(token_store.pack_codes(ids))
        assert len(codes) == n and codes.all().tolist() == ids.tolist()
        assert [codes[i] for i in range(n)] == ids.tolist()
        with pytest.raises(IndexError):
            codes[n]
        if n and ids.max() > 255:
            assert len(codes.levels) > 1 and len(codes.levels[0][3]) == (n + 7) // 8


def brute_tokens(rows):
    encoder, out, at = WordEncoder(PATH).tokenizer, [], 0
    for key, text in rows:
        ids = [*encoder.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        at += len(ids)
    return out


def test_op11_equals_the_library(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = sorted(token_store.op11_token_store(spark, SF).collect())
    assert [tuple(r) for r in got] == [w[:4] for w in brute_tokens(docs)]


def test_tokens_at_any_place(spark, monkeypatch):
    monkeypatch.setattr(token_store, "FILE_TOKENS", 300)
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    all_ids = [i for *_, ids in brute_tokens(sorted((r.doc_id, r.text) for r in docs.collect())) for i in ids]
    files = token_store.with_starts(common.materialize(token_store.token_files(docs, PATH), "t"))
    wanted = [0, 1, 1, 299, 300, 301, len(all_ids) - 1, len(all_ids), -1, None, *random.Random(1).sample(range(len(all_ids)), 200)]
    got = token_store.tokens_at(files, spark.createDataFrame([(p,) for p in wanted], "position long"))
    assert sorted(map(tuple, got.collect())) == sorted((p, all_ids[p]) for p in {p for p in wanted if p is not None and 0 <= p < len(all_ids)})


def test_token_files_of_awkward_tables(spark, monkeypatch):
    monkeypatch.setattr(token_store, "FILE_TOKENS", 50)
    rows = [(1, None), (2, ""), (3, " \n"), (None, "no id"), (4, "word " * 3000), (5, "same"), (5, "same"), (5, "other"), (-7, "日本 <|endoftext|>")]
    docs = clashing(spark, [(i, t, None, None, None) for i, t in rows], DOCS)
    got = sorted(token_store.read_documents(token_store.with_starts(common.materialize(token_store.token_files(docs, PATH), "t"))).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, -7, 1, 2, 3, 4, 5, 5, 5]
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:k]) for k in range(len(got))]
    want = {(w[0], w[2], w[3]) for w in brute_tokens(rows)}
    assert {(r.doc_id, r.n_tokens, r.ids_crc32) for r in got} == want
    empty = spark.createDataFrame([], DOCS)
    assert token_store.read_documents(token_store.with_starts(common.materialize(token_store.token_files(empty, PATH), "t"))).count() == 0


# Manifest


def leaf_of(row, low=False):
    fields = [None if v is None else str(v).encode() for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"])]
    if low and fields[-1] is not None:
        fields[-1] = fields[-1].lower()
    return hashlib.sha256(b"".join(b"-" if f is None else str(len(f)).encode() + b":" + f for f in fields)).hexdigest()


def joined(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_tree(leaves):
    """(root, ways): a way is [(position, run), ...] for each leaf."""
    ways, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for w, i in zip(ways, at, strict=True):
            w.append((i % 8, level[i // 8 * 8 : i // 8 * 8 + 8]))
        level, at = [joined(level[k : k + 8]) for k in range(0, len(level), 8)], [i // 8 for i in at]
    return level[0], ways


def brute_manifest(rows, tampered):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
    trees = {g: brute_tree([leaf_of(r) for r in groups[g]]) for g in order}
    root, over = brute_tree([trees[g][0] for g in order])
    out = []
    for g, up in zip(order, over, strict=True):
        for r, way in zip(groups[g], trees[g][1], strict=True):
            whole, h = way + up, leaf_of(r, low=tampered(r["doc_id"]))
            for at, run in whole:
                h = joined([*run[:at], h, *run[at + 1 :]])
            out.append((r["doc_id"], leaf_of(r), trees[g][0], root, joined([d for at, run in whole for k, d in enumerate(run) if k != at]), h, h == root))
    return out


def key(row):
    return tuple(str(v) for v in row)


@pytest.mark.parametrize(("chunk", "n"), [(3, 100), (5, 600), (7, 1)])
def test_manifest_equals_brute_force(spark, chunk, n):
    rng = random.Random(n)
    rows = [{"doc_id": rng.randrange(2 * n), "text": f"Text {k % 50} A", "lang": rng.choice(["en", "en", "en", None, "", "z", "É", "日"] if n > 40 else ["en"]), "source": None, "n_chars": k} for k in range(n)]
    docs = spark.createDataFrame([tuple(r.values()) for r in rows], DOCS)
    proofs, nodes = manifest.dataset_manifest(docs, F.col("doc_id") % 5 == 0, chunk)
    assert sorted(map(key, proofs.collect())) == sorted(map(key, brute_manifest(rows, lambda d: d is not None and d % 5 == 0)))
    groups = defaultdict(int)
    for r in rows:
        groups["" if r["lang"] is None else ":" + r["lang"]] += 1
    want = sorted((g, level, k) for g, m in groups.items() for level, size in enumerate(manifest.level_sizes(m)) if level for k in range(size))
    assert sorted((r.grp, r.level, r.idx) for r in nodes.collect()) == want


def test_manifest_of_awkward_tables(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, None), (1, "", "", "", 0), (1, "", "", "", 0), (1, "A", "", "", 0), (-3, "x" * 200_000, "en", None, None), (2, "É\x00A", "en", "s", -5)]
    docs = clashing(spark, rows, DOCS)
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    proofs, _ = manifest.dataset_manifest(docs, F.col("doc_id") > 0, 2)
    got = [tuple(r) for r in proofs.collect()]
    want = brute_manifest([dict(zip(names, r, strict=True)) for r in rows], lambda d: d is not None and d > 0)
    assert sorted(map(key, got)) == sorted(map(key, want))
    assert [r[-1] for r in sorted(got, key=key) if r[0] == 2] == [False]
    assert manifest.dataset_manifest(spark.createDataFrame([], DOCS))[0].count() == 0


# Prefix trie

TURNS = "conv_id long, turn long, role string, text string"


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((turn is not None, turn or 0, hashlib.md5(f"{role}\n{text}".encode()).hexdigest(), role, text))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    whole = {}
    for c in own:
        h, family = zlib.crc32(str(c).encode()) % 4, c - int(np.fmod(c, 20))
        whole[c] = tuple(own.get(family, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, convs in members.items():
        words = len([w for w in node[-1][1].translate({c: " " for c in range(9, 14)}).split(" ") if w]) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(convs) - 1) * words
    ends = lambda node: hashlib.sha256(",".join(map(str, sorted(c for c in members[node] if len(whole[c]) == len(node)))).encode()).hexdigest()
    return sorted((min(c), len(n), min(members[n[:-1]]) if n else None, len(c), children.get(n, 0), leaves[n], saved[n], ends(n)) for n, c in members.items())


def trie(frame):
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: (r[0], r[1]))


def some_conversations(seed, n=60):
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(-30, 3 * n), n):
        for t in range(rng.randint(1, 7)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["one", "two words", "", " a\tb\x85c ", "z"])))
    rng.shuffle(rows)
    return rows


def test_trie_equals_brute_force(spark, monkeypatch):
    """Random ones; two long ones that are split over tasks; a chain of conversations that each leave the one before a
    turn later; turns that many share, whose rows are salted."""
    monkeypatch.setattr(prefix_trie, "HOT", 3)
    rows = some_conversations(1)
    rows += [(1007, t, "user", f"w{t % 3} x") for t in range(300)] + [(1003, t, "user", f"w{t % 3} x") for t in range(200)]
    rows += [(2000 + 20 * c, t, "user", f"t{t}" if t < c else f"own {c}") for c in range(20) for t in range(c + 2)]
    rows += [(3001 + c, t, "user", "same" if t < 2 else f"{c % 3}") for c in range(60) for t in range(4)]
    assert trie(prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS).repartition(3))) == brute_trie(rows)


def test_colliding_fingerprints_are_split(spark, monkeypatch):
    plain = prefix_trie._turn_hash

    def weak(parts):
        import pyarrow as pa

        for part in plain(parts):
            yield part.set_column(part.schema.get_field_index("turn_hash"), "turn_hash", pa.array([0] * part.num_rows, pa.int64()))

    rows = [(c, t, "user", x) for c, texts in {1: "aab", 2: "aab", 41: "ab", 42: "ba", 65: "abb", 66: ""}.items() for t, x in enumerate(texts)]
    assert sum(r[1] == 1 for r in brute_trie(rows)) > 1 and sum(r[1] == 2 for r in brute_trie(rows)) > 1
    monkeypatch.setattr(prefix_trie, "_turn_hash", weak)
    assert trie(prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS))) == brute_trie(rows)


def test_trie_of_awkward_tables(spark):
    rows = [(None, 1, "user", "x"), (1, None, None, None), (1, None, "user", "b"), (1, 0, "user", "b"), (1, 0, "user", "b"), (2, 5, "", ""), (21, 0, "user", "x " * 40_000), (40, 1, "user", "first"), (41, 1, "user", "first"), (43, 1, "user", "first")]
    got = trie(prefix_trie.prefix_trie(clashing(spark, rows, TURNS)))
    assert got == brute_trie(rows)
    assert trie(prefix_trie.prefix_trie(spark.createDataFrame([], TURNS))) == []
    assert trie(prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], TURNS))) == []


def test_running_sums_over_ranges(spark):
    rng = random.Random(9)
    rows = [(rng.choice([1, 1, 1, 2, 3]), k, rng.randint(-5, 5)) for k in range(2000)]
    got = {(r.g, r.k): r.v for r in prefix_trie.running_sums(spark.createDataFrame(rows, "g long, k long, v long"), "g", [F.col("k")], ["v"]).collect()}
    want, sums = {}, defaultdict(int)
    for g, k, v in sorted(rows):
        sums[g] += v
        want[g, k] = sums[g]
    assert got == want
