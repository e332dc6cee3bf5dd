"""Packing, SimHash, lattice hashing, language, page text, quality and passages."""

import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from cartwise.llm import components, compression, html_text, langid, lattice, packing, passages, queries, simhash, tokens

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
EDGE = ["", "ΑΣ ς İstanbul ½ 日本 <|endoftext|> a's I'LL \x1c z", "'sé'tx ’s " + "x" * 300, "\x00 \x85 \xa0ǅ ŉ", "a" * 5000 + " b"]


def table(spark, texts):
    return spark.createDataFrame([(None if i == -1 else i, t) for i, t in texts], "doc_id long, text string")


def test_fast_ids_equal_the_tokenizer(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + EDGE
    library = Tokenizer.from_file(PATH)
    for text, ids in zip(texts, tokens.Encoder(PATH).encode(texts), strict=True):
        assert library.encode(text, add_special_tokens=False).ids == ids.tolist()


def test_packing_is_an_exact_round_trip(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    texts += [(10**6 + i, t) for i, t in enumerate(EDGE)] + [(-1, None), (5, "same"), (5, "same")] + [(2 * 10**6 + i, "a") for i in range(300)]
    out = packing.pack_documents(table(spark, texts), "doc_id", "text", PATH, with_ids=True).toPandas()
    library = Tokenizer.from_file(PATH)
    want = {}
    for i, t in texts:
        want.setdefault(None if i == -1 else i, []).append(library.encode(t or "", add_special_tokens=False).ids + [1])
    for i, group in out.groupby(out["doc_id"].astype(object).where(out["doc_id"].notna(), None), dropna=False):
        if len(want[None if i != i else i]) == 1:
            joined = [x for p in group.sort_values("start")["ids"] for x in p]
            assert joined == want[None if i != i else i][0] and (group["doc_tokens"] == len(joined)).all()
    assert out["length"].sum() == sum(len(x) for v in want.values() for x in v)
    for _, seq in out.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert seq["offset"].tolist() == [0, *seq["length"].cumsum().tolist()[:-1]]
        assert seq["length"].sum() <= 2048 and len(seq) <= packing.SEGMENTS
    crc = [zlib.crc32(np.array(p, "<u4").tobytes()) for p in out["ids"]]
    assert crc == out["ids_crc32"].tolist()
    assert out["padding"].sum() <= 0.02 * out["length"].sum()


def test_a_word_of_many_texts_is_looked_up_once():
    class Counted(dict):
        looked = 0

        def __getitem__(self, key):
            Counted.looked += 1
            return super().__getitem__(key)

    encoder = tokens.Encoder(PATH)
    encoder.known = Counted()
    texts = ["  the same\x85words\xa0 again\t", "", " ", "İstanbul isn't far\x0b", "the same words again " * 50] * 40
    got = encoder.encode(texts)
    want = [encoder.library.encode(t, add_special_tokens=False).ids for t in texts[:5]] * 40
    assert [ids.tolist() for ids in got] == want and Counted.looked < 30


def test_rows_of_several_batches_are_encoded_together(monkeypatch):
    batches = [pd.DataFrame({"doc_id": [2**60 + i], "text": [None if i == 3 else "a" * 10]}) for i in range(8)]
    monkeypatch.setattr(packing, "_BATCH_BYTES", 25)
    parts = list(packing._parts(iter(batches)))
    assert [len(names) for names, _ in parts] == [3, 4, 1] and parts[1][1][0] == ""
    assert [n for names, _ in parts for n in names] == [2**60 + i for i in range(8)]


def test_packer_keeps_all_limits_without_cuts():
    rng, packer = random.Random(2), packing.Packer(100, 4, 50, cut=False)
    items = {i: (rng.randint(1, 100), 0) for i in range(700)}
    items = {i: (n, rng.randint(0, min(n, 50))) for i, (n, _) in items.items()}
    placed = [p for i, (n, loss) in items.items() for p in packer.add(i, n, loss)] + list(packer.finish())
    assert sorted(p[1] for p in placed) == sorted(items)
    by = {}
    for seq, i, start, n, at in placed:
        assert start == 0 and n == items[i][0]
        by.setdefault(seq, []).append((at, n, items[i][1]))
    for rows in by.values():
        assert len(rows) <= 4 and sum(r[1] for r in rows) <= 100 and sum(r[2] for r in rows) <= 50


def fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(len(w) - 3, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(n, linked):
    root = list(range(n))
    for a in range(n):
        for b in range(a):
            if linked(a, b):
                x, y = root[a], root[b]
                root = [min(x, y) if r in (x, y) else r for r in root]
    return root


def test_simhash_components_equal_brute_force(spark):
    rng = random.Random(4)
    texts = [(-1, None), (40, ""), (41, " \n"), (42, "one two"), (42, "one two")]
    base = rng.choices([f"w{i}" for i in range(50)], k=120)
    for i in range(40):
        body = list(base)
        for _ in range(rng.randint(0, 3)):
            body[rng.randrange(len(body))] = f"n{rng.random()}"
        texts.append((100 + i, " ".join(body)))
    docs = table(spark, texts)
    rows = docs.select("doc_id", simhash.fingerprints(docs["text"]).alias("fp"))
    out = simhash.simhash_components(rows).collect()
    prints = [fingerprint(t) for _, t in texts]
    root = groups(len(texts), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    least = {r: min((i for (i, _), s in zip(texts, root) if s == r and i != -1), default=None) for r in root}
    want = sorted((str(None if i == -1 else i), f, least[r]) for (i, _), f, r in zip(texts, prints, root))
    assert sorted((str(r.doc_id), r.fp % (1 << 64), r.component_id) for r in out) == want


def test_linked_fingerprints_at_random_distances(spark):
    rng = random.Random(8)
    prints = {rng.getrandbits(64) for _ in range(30)}
    for x in list(prints):
        for _ in range(4):
            for b in rng.sample(range(64), rng.randint(1, 6)):
                x ^= 1 << b
            prints.add(x)
    prints = sorted(prints)
    rows = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x, i) for i, x in enumerate(prints)], "fp long, doc_id long")
    root = groups(len(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    got = {r.doc_id: r.component_id for r in simhash.simhash_components(rows).collect()}
    assert [got[i] for i in range(len(prints))] == root


def test_components_of_long_chains_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    out = components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.id: r.component for r in out} == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_lattice_decoding_finds_the_nearest_point():
    x = np.random.default_rng(1).standard_normal((200, 8)) * 2
    near = lattice.decode_e8(x)
    around = lattice.shortest_vectors()
    assert len(around) == 240
    own = ((x - near) ** 2).sum(1)
    assert (own[:, None] <= ((x[:, None] - near[:, None] - around[None]) ** 2).sum(2) + 1e-9).all()


def test_lattice_links_with_recall_and_without_false_ones(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((60, 32))
    x = [b + rng.standard_normal(32) * rng.uniform(0, 0.45) for b in base for _ in range(6)]
    x += [x[0], x[0] * 3]
    rows = [(i, [float(np.float32(v)) for v in e]) for i, e in enumerate(x)]
    bad = [None, [], [0.0] * 32, [None] + [1.0] * 31, [float("nan")] * 32, [float("inf")] + [1.0] * 31]
    rows += [(1000 + i, e) for i, e in enumerate(bad)]
    df = spark.createDataFrame([(i, e, 1) for i, e in rows], "vec_id long, embedding array<float>, n_links int")
    out = {r.vec_id: r for r in lattice.near_vectors(df, "vec_id", "embedding").collect()}
    assert len(out) == len(rows)
    unit = np.array([e for _, e in rows[: len(x)]])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    want = (unit @ unit.T >= 0.9).sum(1) - 1
    got = np.array([out[i].n_links for i in range(len(x))])
    assert (got <= want).all() and got.sum() >= 0.9 * want.sum() and out[0].n_links >= 2
    for i in range(1000, 1000 + len(bad)):
        assert (out[i].n_links, out[i].component_id, out[i].kept) == (0, i, True)
    assert lattice.near_vectors(df.limit(0), "vec_id", "embedding").collect() == []


def test_language_on_held_out_rows(spark):
    out = queries.op7_language_bitmask(spark, "/root/testdata/sf0.01").toPandas()
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").toPandas()
    both = out.merge(truth, on="doc_id")
    held = both[both["held_out"]]
    assert len(out) == len(truth) and (held["lang_pred"] == held["lang"]).mean() > 0.97
    assert out["score"].between(0, 1).all()


def test_language_of_edge_texts(spark):
    learn = spark.createDataFrame([(1, "der die das und nicht", "de"), (2, "the and of is that", "en"), (3, None, "fr"), (4, "x", None)], "doc_id long, text string, lang string")
    model = langid.learn(learn, "doc_id", "text", "lang")
    assert model.predict("the and of")[0] == "en" and model.predict("nicht und")[0] == "de"
    for text in (None, "", "12 !?", "\n"):
        assert model.predict(text) == ("und", 0.0)
    assert model.predict("жук")[0] in ("de", "en")
    assert langid.learn(learn.limit(0), "doc_id", "text", "lang").predict("the") == ("und", 0.0)


def test_filter_takes_off_expected_false_positives():
    rng = np.random.default_rng(0)
    model = langid.LanguageFilter({"a": rng.integers(0, 1 << 40, 200_000), "b": rng.integers(0, 1 << 40, 1000)})
    assert model.false_share[0] > 0.01
    data = rng.integers(97, 123, 200_000).astype(np.uint8)
    total, held = model.counts(data)
    assert held[0] < 0.3 * model.false_share[0] * total


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header class="site-header"><h1>Site</h1><ul class=menu>
<li><a href=x>Home</a><li><a href=y>News</a></ul></header><div class="cookie-notice">We use cookies. Accept?</div>
<div id=content><h1>Big  title</h1><p>First paragraph, of some length; with <b>bold</b> text. And more.<p>Short.<br>line
<ul><li>one item<li>two items</ul><script>var a="</p>";</script><div class="ad">Buy now!</div><!-- no --><p>Last &amp; more&nbsp;text&#33;</div>
<div class=comments><p>Reader says: nice article, thank you very much. I liked it.</p></div><aside>Side stuff, long, with punctuation.</aside>
<form>Name <input> <button>go</button></form><footer>(c) 2020</footer>"""


def test_page_text(spark):
    want = "Big title\n\nFirst paragraph, of some length; with bold text. And more.\n\nShort. line\n\none item\n\ntwo items\n\nLast & more text!"
    df = spark.createDataFrame([(1, "u", PAGE), (2, None, None), (3, "u", ""), (3, "u", "plain text")], "page_id long, url string, html string")
    out = html_text.extract_text(df.selectExpr("*", "1 AS text", "2 AS n_chars"), ("page_id", "url"), "html").collect()
    assert [(r.page_id, r.text) for r in out] == [(1, want), (2, ""), (3, ""), (3, "plain text")]
    assert all(r.n_chars == len(r.text) for r in out)
    assert html_text.main_text("<div>" * 3000 + "<p>deep text, here." + "<a href='x") == "deep text, here."


def test_page_text_of_the_given_pages(spark):
    import html
    import re

    out = queries.op8_tag_path_text(spark, SF).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in out:
        body = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id], re.S)[1]
        blocks = [html.unescape(re.sub("</?b>", "", b).replace("<br>", " ")) for b in re.split(r"</?p>|</?h1>", body)]
        assert r.text == "\n\n".join(" ".join(b.split()) for b in blocks if b.strip())


def test_page_text_is_chosen_by_ratios_not_by_the_article_tag(spark):
    import re

    body = [f"Paragraph {i} of the page, with some words; and some more of them, too. It ends here." for i in range(6)]
    teaser = "Another story, told at some length; read it on the next page, please."
    page = "<body><div id=content>" + "".join(f"<p>{b}</p>" for b in body) + f"</div><article><p>{teaser}</p></article></body>"
    assert all(b in html_text.main_text(page).split("\n\n") for b in body)
    halves = "<article>" + "".join(f"<p>{b}</p>" for b in body[:3]) + "</article><section>" + "".join(f"<p>{b}</p>" for b in body[3:]) + "</section>"
    assert html_text.main_text(halves).split("\n\n") == body
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        assert html_text.main_text(re.sub(r"(</?)article>", r"\1div>", r.html)) == html_text.main_text(r.html)


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    out = queries.op9_compression_quality(spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    held = out[out["held_out"]].merge(labels, on="doc_id")
    assert out["score"].between(0, 1).all() and (held["predicted"] == held["quality"]).mean() > 0.95
    good = held.loc[held["quality"] == 1, "score"].to_numpy()
    bad = held.loc[held["quality"] == 0, "score"].to_numpy()
    assert (good[:, None] > bad[None]).mean() > 0.97


def test_quality_without_labels_and_of_empty_texts(spark):
    docs = table(spark, [(i, f"good words here {i}" if i % 2 else "!!! $$$ ###") for i in range(40)] + [(-1, None)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 0), (None, 1), (3, None)], "doc_id long, quality int")
    model = compression.learn(docs, labels, "doc_id", "text", "quality")
    assert 0 <= model.score("") <= 1 and model.score(None) == model.score("")
    assert compression.learn(docs, labels.limit(0), "doc_id", "text", "quality").score("x") == 0.5
    assert compression.learn(docs, labels.where("quality = 1"), "doc_id", "text", "quality").score("x") == 1.0


def test_compact_windows_equal_all_spans():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 50, 120).astype(np.uint64) << np.uint64(32)
    text_of = np.repeat([0, 1, 2], [60, 5, 55])
    left, place, right = passages.compact_windows(values, text_of, 8)
    windows = {(int(a), int(b)): int(k) for a, k, b in zip(left, place, right, strict=True)}
    for lo, hi in ((0, 60), (60, 65), (65, 120)):
        for s in range(lo, hi):
            for e in range(s + 8, hi + 1):
                k = s + int(values[s:e].argmin())
                assert sum(a <= s and e - 1 <= b and w == k for (a, b), w in windows.items()) == 1


def passage_table(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    text = lambda n: [word() for _ in range(n)]
    shared, near, short = text(60), text(90), text(45)
    other = list(near)
    other[40] = "changed"
    rows = {i: text(150) for i in range(12)}
    for i in (1, 2, 3):
        rows[i][50:50] = shared
    rows[4][10:10], rows[5][100:100] = near, other
    for i in (6, 7):
        rows[i][20:20] = short
    rows[8] = list(rows[9])
    texts = [(i, " ".join(w)) for i, w in rows.items()] + [(-1, None), (20, ""), (21, "a b")]
    return texts, {1, 2, 3, 4, 5, 8, 9}, (shared, near, short)


def test_planted_passages_are_found_and_clean_texts_left_alone(spark):
    texts, hit, _ = passage_table(spark)
    out = passages.document_passages(table(spark, texts), "doc_id", "text").collect()
    assert {r.doc_id for r in out} | {r.of_doc_id for r in out} == hit
    body = {i: (t or "").split() for i, t in texts}
    for r in out:
        a, b = body[r.doc_id][r.start_word : r.end_word], body[r.of_doc_id][r.of_start : r.of_end]
        assert len(a) >= 50 and r.similarity >= 0.8 and (r.similarity < 1 or a == b)
    assert passages.document_passages(table(spark, texts[-3:]), "doc_id", "text").collect() == []


def test_passage_with_a_line_that_stands_earlier_too(spark):
    rng = random.Random(9)
    text = lambda n: ["".join(rng.choices("abcdefgh", k=6)) for _ in range(n)]
    line, shared = text(7), text(60)
    shared[25:32] = line
    rows = {1: text(100) + shared + text(80), 2: text(30) + line + text(50) + shared + text(90)}
    rows[3] = text(20) + line + text(40) + line + shared + text(10)
    body = {i: " ".join(w) for i, w in rows.items()}
    packed = passages.packed_texts(spark.createDataFrame(list(body.items()), "t long, text string"))
    other = packed.selectExpr("t AS c", "text AS other")
    out = passages.verify(packed.crossJoin(other).where("t <> c"), passages.LENGTH).collect()
    begin = {1: 100, 2: 87, 3: 74}
    assert sorted((r.t, r.c) for r in out) == [(a, b) for a in rows for b in rows if a != b]
    for r in out:
        assert r.start <= begin[r.t] and r.end >= begin[r.t] + 60 and r.of_start <= begin[r.c] and r.similarity >= 0.8
    found = passages.document_passages(table(spark, list(body.items())), "doc_id", "text").collect()
    assert len({r.doc_id for r in found}) == 2


def test_matching_names_all_exact_passages_of_texts_that_repeat_themselves():
    rng = random.Random(1)
    width = passages.LENGTH - passages.SHINGLE + 1
    look = lambda ws: passages._Looked(passages.shingles(passages.hash_words(" ".join(ws).encode())[0]), passages._least_run(width, 0.8))
    for vocabulary in (2, 3, 5, 20, 200) * 20:
        known = [f"w{i}" for i in range(vocabulary)]
        a, b, same = (rng.choices(known, k=rng.randint(50, 160)) for _ in range(3))
        a[20:20], b[40:40] = same, same
        covered, runs = set(), {tuple(b[i : i + 50]) for i in range(len(b) - 49)}
        for start, end, lo, hi, value in passages._stretches(look(a), look(b), width, 0.8):
            x, y = ({tuple(t[i : i + 5]) for i in range(*at)} for t, at in ((a, (start, end)), (b, (lo, hi))))
            assert abs(len(x & y) / len(x | y) - value) < 1e-9 and value >= 0.8 and min(end - start, hi - lo) >= width
            covered.update(range(start, end + 4))
        for i in range(len(a) - 49):
            assert tuple(a[i : i + 50]) not in runs or covered.issuperset(range(i, i + 50))


def test_removed_passages_stay_once(spark):
    texts, hit, (shared, _, short) = passage_table(spark)
    docs = table(spark, texts).selectExpr("doc_id", "text", "monotonically_increasing_id() AS _row", "1 AS extra")
    out = passages.remove_passages(docs, "doc_id", "text").collect()
    left = {r.doc_id: r.text for r in out}
    assert sum(" ".join(shared) in (t or "") for t in left.values()) == 1
    assert sum(" ".join(short) in (t or "") for t in left.values()) == 2
    assert len({8, 9} & left.keys()) == 1 and left[None] is None and left[20] == ""
    assert all(left[i] == dict(texts)[i] for i in (0, 6, 7, 10, 11, 21))


def test_pipeline_keeps_clean_documents_and_catches_planted_ones(spark, tmp_path):
    texts, _, _ = passage_table(spark)
    item = " ".join(f"benchword{i}" for i in range(12))
    texts = [t for t in texts if t[0] != 9] + [(30, "clean start " + item + " end"), (31, "12 34"), (32, texts[0][1])]
    rows = [(None if i == -1 else i, t, "en", "s", len(t or "")) for i, t in texts]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == {0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 11, 21}
    library = Tokenizer.from_file(PATH)
    whole = {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts if t}
    assert all(r.doc_tokens == whole[r.doc_id] for r in out if r.doc_id in (0, 6, 7, 8, 10, 11, 21))
    cut = [i for i in (1, 2, 3) if any(r.doc_id == i and r.doc_tokens < whole[i] for r in out)]
    assert len(cut) == 2
