"""Sharding, license scan and decontamination on hand-made tables."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from cartwise.llm import decontaminate, license_scan, sharding

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def docs(spark, texts, extra=False):
    rows = [(i if i != -1 else None, t) for i, t in texts]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.selectExpr("doc_id", "text", "1 AS depth", "'x' AS shard", "2 AS n_words", "3 AS hash") if extra else df


def test_shards_fit_and_split_no_more_than_needed(spark):
    rng = random.Random(3)
    texts = [(i, "x" * rng.randint(0, 60)) for i in range(300)]
    texts += [(7, "y" * 20)] * 120 + [(500, "z" * 900), (-1, None), (-1, "ü" * 5)]
    out = sharding.assign_shards(docs(spark, texts, True), "doc_id", "text", 400).collect()
    assert len(out) == len(texts)
    assert sum(r.bytes for r in out) == sum(len((t or "").encode()) for _, t in texts)
    shards = {}
    for r in out:
        shards.setdefault(r.shard, []).append(r)
    for name, rows in shards.items():
        size = sum(r.bytes for r in rows)
        assert size <= 400 or len(rows) == 1
        assert {(r.depth, r.shard_bytes, r.shard_rows) for r in rows} == {(len(name), size, len(rows))}
    names = sorted(shards)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))
    for name in names:  # a bucket's parent did not fit
        inside = [r for n, rows in shards.items() if n.startswith(name[:-1]) for r in rows]
        assert not name or sum(r.bytes for r in inside) > 400


def test_shards_of_an_empty_table_and_of_one_small_one(spark):
    assert sharding.assign_shards(docs(spark, []), "doc_id", "text", 10).collect() == []
    (row,) = sharding.assign_shards(docs(spark, [(1, "abc")]), "doc_id", "text", 10).collect()
    assert (row.shard, row.depth, row.shard_bytes, row.shard_rows) == ("", 0, 3, 1)


def test_written_shards_hold_every_row(spark, tmp_path):
    table = docs(spark, [(i, "x" * 50) for i in range(40)])
    shards = sharding.assign_shards(table, "doc_id", "text", 400)
    sharding.write_shards(table, shards, "doc_id", str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 40


def test_written_shards_of_a_divided_key_keep_the_limit(spark, tmp_path):
    table = docs(spark, [(i, "x" * 50) for i in range(40)] + [(7, "y" * 50)] * 60)
    shards = sharding.shard_table(table, "doc_id", "text", 400, str(tmp_path / "out")).collect()
    folder = F.regexp_extract(F.input_file_name(), "shard=([^/]*)", 1)
    out = spark.read.parquet(str(tmp_path / "out")).groupBy(folder.alias("at")).agg(F.sum(F.octet_length("text")).alias("size"), F.count("*").alias("n"))
    written = {r["at"]: (r["size"], r["n"]) for r in out.collect()}
    assert written == {r.shard: (r.shard_bytes, r.shard_rows) for r in shards}
    assert sum(n for _, n in written.values()) == 100 and max(size for size, _ in written.values()) <= 400
    with pytest.raises(ValueError):
        sharding.write_shards(table, sharding.assign_shards(table, "doc_id", "text", 400), "doc_id", str(tmp_path / "no"))


def test_license_phrases_anywhere_and_sentences_on_a_line(spark):
    texts = [
        (1, "Released under the MIT License. And the mit\nlicense again"),
        (2, "apache LICENSE, General Public License"),
        (3, "Permission is hereby granted, free of charge, to any person obtaining a copy of this thing"),
        (4, "mitlicense; license mit"),
        (5, ""),
        (-1, None),
        (6, "lİcense MIT lİcense"),
        (6, "lİcense MIT lİcense"),
    ]
    out = {}
    for r in license_scan.license_scan(docs(spark, texts, True), "doc_id", "text").collect():
        out.setdefault(r.doc_id, []).append(r)
    one = out[1][0]
    assert (one.n_words, one.n_base, one.first_word, one.last_word) == (10, 2, 3, 7)
    assert one.base_labels == "mit" and one.labels == "mit,mit-notice" and one.score == 1.0
    two = out[2][0]
    assert (two.n_base, two.base_labels, two.first_word, two.last_word) == (2, "apache,gpl", 0, 2)
    three = out[3][0]
    assert three.n_base == 0 and three.labels == "mit-grant" and 0.8 <= three.score < 1
    assert [(m.line, m.template) for m in three.matches] == [(0, "mit-grant")]
    for r in (out[4][0], out[5][0], out[None][0], *out[6]):
        assert (r.n_base, r.first_word, r.base_labels, r.labels, r.score) == (0, None, "", "", 0.0)
    assert len(out[6]) == 2


def test_license_sentences_wrapped_over_lines(spark):
    import textwrap

    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that"
    grant = "Permission is hereby granted, free of charge, to any person obtaining\na copy of this software and"
    texts = [(1, bsd), (2, grant), (3, "all words\nof these rights\nare reserved")]
    names = sorted(license_scan.TEMPLATES)
    for width in (18, 30, 72):
        for i, name in enumerate(names):
            body = "some words that fill the line before it " + license_scan.TEMPLATES[name] + " and what follows after it"
            texts.append((100 * width + i, "\n * ".join(textwrap.wrap(body, width))))
    out = {r.doc_id: r for r in license_scan.license_scan(docs(spark, texts), "doc_id", "text").collect()}
    assert [(m.line, m.template) for m in out[1].matches] == [(0, "bsd")] and out[1].score == 1.0
    assert [(m.line, m.template) for m in out[2].matches] == [(0, "mit-grant")]
    assert (out[3].labels, out[3].score) == ("", 0.0)
    for width in (18, 30, 72):
        for i, name in enumerate(names):
            assert name in out[100 * width + i].labels.split(",")


def test_similarity_join_equals_counting_out(spark):
    rng = random.Random(1)
    vocabulary = sorted({w for s in license_scan.TEMPLATES.values() for w in s.split()})
    lines = [" ".join(rng.choices(vocabulary + ["zz"], k=rng.randint(1, 25))) for _ in range(60)]
    for s in license_scan.TEMPLATES.values():
        w = s.split()
        lines += [" ".join(rng.sample(w, max(1, int(len(w) * f)))) for f in (0.7, 0.8, 0.9, 1)]
    out = license_scan.license_scan(docs(spark, list(enumerate(lines))), "doc_id", "text").collect()
    for r in out:
        held = set(lines[r.doc_id].split())
        want = {
            n: len(held & set(s.split())) / len(set(s.split()))
            for n, s in license_scan.TEMPLATES.items()
            if len(held & set(s.split())) / len(set(s.split())) >= 0.8
        }
        assert {m.template: m.share for m in r.matches} == want


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(5)
    vocab = ["a", "b", "c", "d"] + [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([1, 3, 10, 14])))) for i in range(12)]
    items += [(3, items[3][1]), (-1, "only null id here"), (90, ""), (91, None)]
    texts = []
    for i in range(60):
        body = rng.choices(vocab, k=rng.randint(0, 40))
        if i % 3 == 0:
            body[5:5] = words(rng.choice(items[:12])[1].upper())
        texts.append((i, ", ".join(body)))
    texts += [(-1, None), (60, ""), (61, "only NULL id here."), (61, "only NULL id here.")]
    bench = docs(spark, items).withColumnRenamed("doc_id", "item_id")
    rows = decontaminate.word_rows(docs(spark, texts, True), "doc_id", "text")
    out = decontaminate.decontaminate(rows, bench, "item_id", "text").orderBy("_row").collect()
    want = []
    for i, t in texts:
        w, hit, names = words(t), set(), set()
        for item, text in items:
            v = words(text)
            for s in range(max(len(v) - 9, 1)) if v else ():
                win = v[s : s + 10]
                for p in range(len(w) - len(win) + 1):
                    if w[p : p + len(win)] == win:
                        hit.update(range(p, p + len(win)))
                        names.add("" if item == -1 else str(item))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        want.append((str(None if i == -1 else i), len(w), len(hit), len(names), digest, bool(hit)))
    key = lambda r: tuple(map(str, r))
    got = [(str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in out]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_proximity_matches_lie_within_the_slop(spark):
    rows = decontaminate.word_rows(docs(spark, [(1, "q red x x blue"), (2, "red blue"), (3, "blue z z z z red")]), "doc_id", "text")
    wins = decontaminate.benchmark_windows(spark.createDataFrame([(1, "red blue")], "item_id long, text string"), "item_id", "text")
    found = {(r._row, r.gap) for r in decontaminate.find_matches(rows, wins, 2).collect()}
    by_doc = {r._row: r.doc_id for r in rows.collect()}
    assert {(by_doc[a], g) for a, g in found} == {(1, 2), (2, 0)}


def test_decontamination_counts_proximity_matches_beside_exact_ones(spark):
    texts = [(1, "q red x x blue"), (2, "red blue"), (3, "blue z z z z red"), (4, "green green green"), (5, None)]
    rows = decontaminate.word_rows(docs(spark, texts), "doc_id", "text")
    bench = spark.createDataFrame([(1, "red blue"), (2, "green")], "item_id long, text string")
    plain = decontaminate.decontaminate(rows, bench, "item_id", "text")
    near = decontaminate.decontaminate(rows, bench, "item_id", "text", slop=2)
    assert near.columns == [*plain.columns, "n_near"]
    assert {r.doc_id: r.n_near for r in near.collect()} == {1: 1, 2: 0, 3: 0, 4: 0, 5: 0}
    assert sorted(near.drop("n_near").collect(), key=str) == sorted(plain.collect(), key=str)


def test_empty_tables(spark):
    none = docs(spark, [])
    rows = decontaminate.word_rows(none, "doc_id", "text")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(rows, bench, "item_id", "text").collect() == []
    assert license_scan.license_scan(none, "doc_id", "text").collect() == []
    rows = decontaminate.word_rows(docs(spark, [(1, "a b")]), "doc_id", "text")
    (row,) = decontaminate.decontaminate(rows, bench, "item_id", "text").collect()
    assert (row.n_hit, row.n_items, row.items_sha256) == (0, 0, hashlib.sha256(b"").hexdigest())
