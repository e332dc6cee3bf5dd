"""Token shards, burst tries and periodic runs against plain versions."""

import hashlib
import os
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cartwise.llm import burst_trie, elias_fano, periodic, queries, token_store

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
EDGE = ["", " ", "\n\n x", "a<|endoftext|>b", "ΑΣ ς İstanbul ½ 日本", "'sé'tx ’s I'LL  we've", "\x00\x1c\x85 \xa0ǅ ŉ 12 345", "a" * 5000 + " b"]


# --- operator 11 -------------------------------------------------------------------


@pytest.mark.parametrize(
    "values",
    [[], [7], [0] * 1000, [-(2**63), 2**63 - 1], list(range(0, 9000, 3)), [0] * 3000 + [10**12] * 3 + [10**15], "random", "steps"],
)
def test_elias_fano_select_and_rank(values):
    rng = np.random.default_rng(4)
    if isinstance(values, str):
        values = np.sort(rng.integers(-(2**63), 2**63 - 1, 5000)) if values == "random" else np.cumsum(rng.integers(0, 9, 70_000))
    values = np.array(values, np.int64)
    coded = elias_fano.encode(values)
    seq = elias_fano.Sequence(coded)
    assert len(seq) == len(values) and (seq.range(0, len(values)) == values).all()
    for i in rng.integers(0, len(values), 30).tolist() if len(values) else []:
        j = int(rng.integers(i, len(values) + 1))
        assert seq[i] == values[i] and (seq.range(i, j) == values[i:j]).all()
        assert seq.rank(int(values[i])) == np.searchsorted(values, values[i], side="right")
    if len(values) == 70_000:  # 2 bits, the low bits and the kept places
        assert len(coded) * 8 / len(values) < 2 + np.log2(4) + 0.5
    with pytest.raises(ValueError):
        elias_fano.encode(np.array([2, 1]))


def _ids(text):
    return [*Tokenizer.from_file(VOCABULARY).encode(text or "", add_special_tokens=False).ids, 2]


def test_pieces_encode_as_the_tokenizer_does(spark):
    texts = [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + EDGE
    library = Tokenizer.from_file(VOCABULARY)
    for text, ids in zip(texts, token_store.PieceEncoder(VOCABULARY, 2).encode(texts), strict=True):
        assert library.encode(text, add_special_tokens=False).ids == np.frombuffer(ids, "<u2").tolist()


@pytest.mark.parametrize("width", [2, 4])
def test_token_shards_round_trip(spark, tmp_path, width):
    rng = random.Random(width)
    rows = [(rng.choice([None, i, -i, 2**62 + i]), rng.choice([None, *EDGE, "word " * i]), "x") for i in range(200)]
    rows += [(5, "same", "x"), (5, "same", "x"), (5, "other", "x"), *[(11, f"hot {i % 7}", "x") for i in range(300)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(5)
    path = f"file://{tmp_path}/data"
    token_store.write_token_shards(docs, "doc_id", "text", VOCABULARY, path, width=width, shard_text=1 << 12)
    found = sorted(token_store.read_token_shards(spark, path).collect(), key=lambda r: r.start)
    keys = [r.doc_id for r in found]
    assert keys == sorted((r[0] for r in rows), key=lambda k: (k is not None, k or 0))
    assert [r.start for r in found] == [0, *np.cumsum([r.n_tokens for r in found]).tolist()[:-1]]
    got, want = defaultdict(list), defaultdict(list)
    for r in found:
        got[r.doc_id].append(np.frombuffer(r.ids, "<u4").tolist())
    for key, text, _ in rows:
        want[key].append(_ids(text))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    fs, folder, shards = token_store.open_manifest(path)
    assert len(shards) > 3 and max(s["documents"] for s in shards) < 300  # the hot id lies in several shards
    at = 0
    for s in shards:
        with token_store.Shard(fs, f"{folder}/{s['file']}") as shard:
            assert (shard.n_docs, shard.n_tokens) == (s["documents"], s["tokens"])
            for i in (0, shard.n_docs // 2, shard.n_docs - 1):
                start, end = shard.bounds(i, i + 1).tolist()
                row = found[at + i]
                assert shard.document(i).tolist() == np.frombuffer(row.ids, "<u4").tolist() and end - start == row.n_tokens
                assert shard.document_at(start) == i == shard.document_at(end - 1)
        at += s["documents"]


def test_unfinished_or_unsorted_data_sets_are_not_read(spark, tmp_path):
    docs = spark.createDataFrame([(i, "a b") for i in range(20)], "doc_id long, text string")
    path = f"{tmp_path}/data"
    bad = docs.select(F.col("doc_id"), F.lit(b"ab").alias("ids")).orderBy(F.desc("doc_id")).coalesce(1)
    spark.dataSource.register(token_store.TokenShards)
    with pytest.raises(Exception, match="must not decrease"):
        bad.write.format("token_shards").mode("append").save(path)
    with pytest.raises(Exception):
        token_store.read_token_shards(spark, path).collect()
    token_store.write_token_shards(docs, "doc_id", "text", VOCABULARY, path)
    with pytest.raises(Exception, match="holds a data set already"):
        token_store.write_token_shards(docs, "doc_id", "text", VOCABULARY, path)
    assert token_store.read_token_shards(spark, path, ids=False).where("ids IS NULL").count() == 20
    with pytest.raises(ValueError):
        token_store.PieceEncoder(VOCABULARY, 1)


def test_no_documents_make_an_empty_data_set(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    token_store.write_token_shards(docs, "doc_id", "text", VOCABULARY, f"{tmp_path}/none")
    assert token_store.read_token_shards(spark, f"{tmp_path}/none").count() == 0
    assert token_store.open_manifest(f"{tmp_path}/none")[2] == []


def test_op11_query_equals_a_plain_count(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    found = {r.doc_id: r for r in queries.op11_elias_fano_tokens(spark, SF).collect()}
    start = 0
    for key, text in docs:
        ids = _ids(text)
        assert (found[key].start, found[key].n_tokens) == (start, len(ids))
        assert found[key].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert len(found) == len(docs)


# --- operator 12 -------------------------------------------------------------------

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_trie(rows, shared_heads):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}
    if shared_heads:
        head = {c: zlib.crc32(str(c).encode()) % 6 for c in convs}
        convs = {c: convs.get(c - c % 100, [])[: head[c]] + v[head[c] :] for c, v in convs.items()}
    members, children = defaultdict(list), defaultdict(list)
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    out = []
    for path, own in members.items():
        below, leaves, saved = [path], 0, 0
        while below:
            p = below.pop()
            leaves += not children[p]
            saved += (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
            below += children[p]
        ends = ",".join(map(str, sorted(c for c in own if len(convs[c]) == len(path))))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(own), len(path), parent, len(own), len(children[path]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def _turns(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, box string")


def _nodes(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in burst_trie.with_hashes(df).collect()), key=str)


@pytest.mark.parametrize(("limit", "shared_heads"), [(12, False), (60, True), (10**6, True)])
def test_trie_equals_a_plain_one(spark, limit, shared_heads):
    rng = random.Random(limit)
    rows = {}
    for c in range(60):
        conv = rng.choice([c, c * 37, c + 10**9])
        for t in range(rng.randint(1, 7)):
            turn = None if rng.random() < 0.1 else t
            rows[conv, turn] = (conv, turn, rng.choice(["u", "a", None]), rng.choice(["x", "yé", None, "long text"]))
    rows = [*rows.values(), (None, 1, "u", "x"), *[(200 * i, 5, "u", "only") for i in range(500, 520)]]
    rows += [(7000 + i, t, "u", f"same{t}") for i in range(40) for t in range(9)]  # copies
    rows += [(8000 + i, t, "u", "deep") for i in range(4) for t in range(25 + i)]  # a long chain
    convs = burst_trie.conversations(_turns(spark, rows), "conv_id", "turn", "role", "text")
    convs = burst_trie.with_shared_heads(convs) if shared_heads else convs
    assert _nodes(burst_trie.prefix_trie(convs, limit)) == plain_trie(rows, shared_heads)


def test_trie_of_repeated_turns_and_of_nothing(spark):
    rows = [(1, 0, "u", "a"), (1, 0, "u", "a"), (1, 0, "a", "b"), (3, None, None, None)]
    convs = burst_trie.conversations(_turns(spark, rows), "conv_id", "turn", "role", "text")
    assert _nodes(burst_trie.prefix_trie(convs)) == plain_trie(rows, False)
    none = burst_trie.conversations(_turns(spark, rows).limit(0), "conv_id", "turn", "role", "text")
    assert burst_trie.prefix_trie(none).columns == COLUMNS and burst_trie.prefix_trie(none).isEmpty()


def test_ids_of_a_large_group_are_hashed_in_order(spark):
    rows = [(c, 0, "u", "same") for c in random.Random(1).sample(range(-9000, 60_000), 9500)]
    found = _nodes(burst_trie.prefix_trie(burst_trie.conversations(_turns(spark, rows), "conv_id", "turn", "role", "text")))
    assert found == plain_trie(rows, False)


# --- operator 13 -------------------------------------------------------------------


def plain_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            a, b = i, j + q
            if j > i and b - a >= max(6, 4 * q):
                smaller = any(all(words[t] == words[t + r] for t in range(a, b - r)) for r in range(1, q))
                if not smaller:
                    out.append((a, b - a, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def _periodic(rng, letters, most):
    words = []
    while len(words) < rng.randint(0, most):
        base = [rng.choice(letters) for _ in range(rng.randint(1, 25))]
        words += (base * rng.randint(1, 9))[: rng.randint(1, 150)]
    return words


def test_transforms_count_differences_exactly():
    rng = np.random.default_rng(2)
    for size in (1, 2, 8, 64):
        blocks, windows = rng.integers(0, 5, (7, size)), rng.integers(0, 5, (7, 2 * size))
        want = [[int(((b - w[d : d + size]) ** 2).sum()) for d in range(size)] for b, w in zip(blocks, windows)]
        for prime, generator in periodic.PRIMES:
            assert periodic.squared_differences(blocks, windows, prime, generator).tolist() == want


def test_runs_equal_plain_ones():
    rng = random.Random(6)
    for _ in range(150):
        documents = [_periodic(rng, "abcdefgh"[: rng.choice([1, 2, 3, 8])], 120) for _ in range(rng.randint(0, 5))]
        words = periodic.Words(documents)
        found = [[] for _ in documents]
        for a, b, q in words.runs().tolist():
            found[words.document[a]].append((a - int(words.begin[a]), b - a, q))
        assert found == [plain_runs(d) for d in documents]


def test_runs_of_large_numbers_need_several_primes():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(70_000)] + [f"w{rng.randrange(70_000)}" for _ in range(300)] * 5
    found = periodic.Words([words]).runs()
    assert [b - a for a, b, q in found.tolist()] == [1500] and found[0, 2] == 300


def test_runs_of_long_texts_end_in_time(spark):
    texts = [("a " * 30_000), ("a " * 1000 + "b ") * 30, None, "", " \t\x0b\x85 ", "x"]
    df = spark.createDataFrame([(1, t, 2, "r") for t in texts], "doc_id long, text string, n_words int, runs string")
    found = periodic.find_runs(df, "doc_id", "text").collect()
    assert [len(r.runs) for r in found] == [1, 31, 0, 0, 0, 0]
    assert [r.n_words for r in found] == [30_000, 30_030, 0, 0, 1, 1]
    assert found[0].collapsed == "a" and (0, 30_030, 1001) in map(tuple, found[1].runs) and found[4].collapsed == "\x85"
    assert periodic.find_runs(df.limit(0), "doc_id", "text").count() == 0
    with pytest.raises(ValueError):
        periodic.find_runs(df, "doc_id", "text", times=2)


def test_op13_query_equals_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 3000 OR text IS NULL")
    rng = random.Random(8)
    extra = [(10**6 + i, " ".join(_periodic(rng, "abc", 80))) for i in range(60)] + [(None, "a a a a a a a"), (31, None)]
    rows = [(r.doc_id, r.text) for r in docs.collect()] + extra
    want = []
    for key, text in rows:
        words = (text or "").encode().split()
        n, h = len(words), zlib.crc32(str(key).encode()) if key is not None else 1
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        gone = {i for a, length, q in runs for i in range(a + q, a + length)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        four = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        lines = "".join(f"{a},{length},{q}\n" for a, length, q in runs)
        want.append((key, len(runs), *four, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()))
    folder = f"{spark.sparkContext.getCheckpointDir() or '/tmp'}/op13-{os.getpid()}"
    spark.createDataFrame(rows, "doc_id long, text string").write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    found = [tuple(r) for r in queries.op13_periodic_runs(spark, folder).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert sum(r[1] > 0 for r in found) > 30

