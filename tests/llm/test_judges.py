"""URL filter, decontamination, language identification and the pipeline."""

import hashlib
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from strata.llm import decontaminate, language_id, url_filter

BYTE_WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2]


def rule_of(host, path):
    fits = [r for r, _ in url_filter.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits, key=len, default=None)


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.COM/en/x?y#z", "http://www.example.com/en/1", "http://a.www.example.com/en/", "http://notexample.com/en/",
            "http://x.net/es/1", "http://x.net/es", "http://net/fr/?q", "http://É.COM/Ä\nb", "a://b.com?x://y.net/es/", "http://x.org/" + "9" * 20_000, "http://x.org/en/1"]
    rows = [(i, u, "clash", "h") for i, u in enumerate(urls + urls[4:6])]
    got = {r["page_id"]: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, rule string, n_url string"), trees=2).collect()}
    assert len(got) == len(rows)
    for i, u, *_ in rows:
        host, path = parsed(u)
        rule = rule_of(host, path)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), u
        assert got[i]["verdict"] in {"allow", "block"} and (rule is None or got[i]["verdict"] == dict(url_filter.RULES)[rule])


def test_urls_without_labels(spark):
    df = spark.createDataFrame([(1, "http://x.org/"), (2, None)], "page_id long, url string")
    assert {r["verdict"] for r in url_filter.judge(df).collect()} == {"allow"}
    assert {r["verdict"] for r in url_filter.judge(df.union(spark.createDataFrame([(3, "http://x.net/es/")], df.schema))).collect()} == {"block"}
    assert url_filter.judge(df.limit(0)).count() == 0


def test_trees_learn_the_labels(spark):
    pages = [(i, f"http://h{i % 7}.example.{('com', 'net')[i % 2]}/{('en', 'de')[i % 3 == 0]}/{i}") for i in range(400)]
    df = spark.createDataFrame(pages, "page_id long, url string")
    host, path = url_filter.host_and_path(df["url"])
    from pyspark.sql import functions as F
    rows = url_filter.lexical(df.withColumns({"host": host, "path": path}).withColumn("label", (F.col("page_id") % 2).cast("int")))
    model, statistics, rate = url_filter.train(rows.where("page_id % 5 != 0"), trees=5)
    from pyspark.ml.feature import VectorAssembler
    held = VectorAssembler(inputCols=url_filter.FEATURES, outputCol="features").transform(url_filter.with_suffix(rows.where("page_id % 5 = 0"), statistics, rate))
    assert model.transform(held).where("prediction = label").count() > 0.95 * held.count()


def test_training_sample_is_bounded_whatever_the_copies(spark, monkeypatch):
    from pyspark.sql import functions as F
    pages = [(i, "http://x.example.com/en/" if i % 3 else f"http://x.net/es/{i}", int(i % 3 == 0)) for i in range(900)]
    df = spark.createDataFrame(pages, "page_id long, url string, label int")
    host, path = url_filter.host_and_path(df["url"])
    rows, seen, old = url_filter.lexical(df.withColumns({"host": host, "path": path})), [], url_filter.stage
    monkeypatch.setattr(url_filter, "stage", lambda made, name: seen.append((name, old(made, name))) or seen[-1][1])
    assert url_filter.train(rows, max_rows=1000, trees=1)[2] == 300 / 900
    sample = dict(seen)["url-training"]
    assert sample.count() == 301 and sample.agg(F.sum("weight")).first()[0] == 900


@pytest.mark.parametrize("block_words", [250_000, 40])
def test_decontamination(spark, odd_docs, odd_rows, block_words):
    items = [(1, " ".join(odd_rows[0][1].split()[:30])), (2, "One"), (10, None), (11, ""), (None, " ".join(odd_rows[9][1].split()[5:40])), (2, "one"), (12, odd_rows[-3][1][:4000])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    low = lambda t: BYTE_WORDS.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in (t or "").encode()))
    windows = {}
    for i, t in items:
        w = low(t)
        n = min(13, len(w))
        for j in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[j:j + n]), set()).add("" if i is None else str(i))
    want = []
    for i, t in odd_rows:
        w, hit, found = low(t), set(), set()
        for n in {len(k) for k in windows}:
            for j in range(len(w) - n + 1):
                if tuple(w[j:j + n]) in windows:
                    hit.update(range(j, j + n))
                    found |= windows[tuple(w[j:j + n])]
        want.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    got = decontaminate.judge(odd_docs, benchmark, block_words=block_words)
    key = lambda r: tuple(map(str, r))
    assert sorted([tuple(r) for r in got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()], key=key) == sorted(want, key=key)
    assert decontaminate.judge(odd_docs, benchmark.limit(0)).where("n_hit > 0").count() == 0


def labelled(spark, n=240):
    rng = np.random.default_rng(1)
    sounds = {"aa": ["ba", "da", "ga"], "bb": ["wix", "zyk", "quo"], "cc": ["éu", "çã", "ñó"]}
    rows = []
    for i in range(n):
        lang = list(sounds)[i % 3]
        rows.append((i, " ".join("".join(rng.choice(sounds[lang], 3)) for _ in range(40)), lang, "s", i))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string, n_chars long")


def test_language_of_held_out_documents(spark):
    docs = labelled(spark)
    odd = spark.createDataFrame([(900, None, "aa", "", 0), (901, "123 .,", "bb", "", 0), (902, "", None, "", 0), (None, "bada gada", None, "", 0), (903, "ba" * 50_000, None, "", 0)], docs.schema)
    model = language_id.fit_on_rest(docs.union(odd), epochs=8)
    got = {r["doc_id"]: r for r in language_id.predict(docs.union(odd).drop("score"), model).collect()}
    held = [i for i in range(240) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(got[i]["lang_pred"] == got[i]["lang"] for i in held) > 0.95 * len(held)
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (900, 901, 902))
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[903]["lang_pred"] == "aa"
    out = language_id.identify(docs, epochs=1).collect()
    assert {r["doc_id"] for r in out if r["held_out"]} == set(held)


def test_language_tables_equal_the_convolution():
    rng = np.random.default_rng(2)
    model = language_id.train(rng.integers(0, 256, (64, 256)).astype(np.uint8), rng.integers(0, 2, 64), ["a", "b"], epochs=1)
    x = rng.integers(0, 256, (3, 256))
    hidden = []
    for width, bank, bias in zip(language_id.WIDTHS, model.filters, model.biases, strict=True):
        span = 256 - width + 1
        hidden.append(sum(model.embedding[x[:, j:j + span]] @ bank[j] for j in range(width)).max(axis=1) + bias)
    want = language_id.softmax(np.maximum(np.concatenate(hidden, axis=1), 0) @ model.weights + model.offset)
    assert np.allclose(model.predictor()(x.astype(np.uint8)), want, atol=1e-4)


def test_language_without_labels(spark, no_docs):
    assert language_id.identify(no_docs).count() == 0
    docs = labelled(spark, 6).selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r["lang_pred"] for r in language_id.identify(docs).collect()} == {"und"}


def test_pipeline(spark, tmp_path):
    docs = labelled(spark)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    shared = "".join(chr(97 + i * 7 % 26) for i in range(260))
    item = " ".join(f"question{i}" for i in range(20))
    more = [(500, texts[3] + " extra", "aa", "s", 0), (501, None, "aa", "s", 0), (502, "12 34", "aa", "s", 0), (503, texts[7][:150] + item, "bb", "s", 0),
            (504, "bada " * 8 + shared, "aa", "s", 0), (505, "gaba " * 8 + shared, "aa", "s", 0)]
    all_docs = docs.union(spark.createDataFrame(more, docs.schema))
    all_docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert not set(out) & {500, 501, 502, 503} and {504, 505} <= set(out)
    assert len(out) > 200
    left = ("bada " * 8)[:-2]  # the two texts agree from the "a " before the shared passage on
    assert out[504]["decoded_sha256"] == hashlib.sha256(left.encode()).hexdigest()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        none = all_docs.limit(0)
        made = stage(spark, none, str(tmp_path))
        assert made.columns == none.columns and made.count() == 0, name


def test_near_dedup_keeps_one_row_of_each_component(spark, tmp_path):
    words = [" ".join(f"{c}{i}" for i in range(40)) for c in "abcde"]
    rows = [(1, words[0], 0), (1, words[0], 0), (1, words[0] + " z", 1), (None, words[0], 2), (2, words[1], 0), (2, words[2], 0),
            (None, words[3], 0), (None, words[3], 1), (None, words[4], 0), (5, words[4], 0), (6, "", 0), (6, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `n.x` int")
    out = corpus_pipeline.near_dedup(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    found = sorted(((r["doc_id"], r["text"][:2]) for r in out.collect()), key=str)
    assert found == sorted([(1, "a0"), (2, "b0"), (2, "c0"), (None, "d0"), (5, "e0"), (6, ""), (6, "")], key=str)


def test_words_that_polynomials_confuse_do_not_contaminate(spark):
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    one, two = ("".join(pair[i] for i in bits) for pair in ("ab", "ba"))
    lead = [f"w{i}" for i in range(12)]
    docs = spark.createDataFrame([(1, " ".join([*lead, one])), (2, " ".join([*lead, two]))], "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join([*lead, two]))], "item_id long, text string")
    assert {r.doc_id: (r.n_hit, r.n_items) for r in decontaminate.judge(docs, items).collect()} == {1: (0, 0), 2: (13, 1)}


def test_pipeline_keeps_documents_that_only_hash_alike(spark, tmp_path):
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    rows = [(i, "".join(pair[j] for j in bits) + " the house and the garden", "en", "s", 1) for i, pair in enumerate(("ab", "ba"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    assert {r.doc_id for r in stages["near_dedup"](spark, docs, str(tmp_path)).collect()} == {0, 1}


def test_a_label_of_copies_and_repeated_ids_is_learned(spark):
    """Thousands of rows of one id, and a text that holds most rows of a label, neither lose a label nor flood the sample."""
    rows = [(1, f"aaa aa aaaa {i} aa", "aa") for i in range(3000)] + [(i, "bbb bb bbbb bb", "bb") for i in range(3000)] + [(i, f"bb b{i} bbb", "bb") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = language_id.fit(docs, per_label=50, epochs=1) if "epochs" in language_id.train.__code__.co_varnames else language_id.fit(docs, per_label=50)
    assert model.labels == ["aa", "bb"]


def test_results_replace_columns_of_their_names_in_any_case(spark):
    pages = spark.createDataFrame([(1, "http://x.net/es/1", 1.0, 2.0, 3.0, "h"), (2, "http://y.org/", 1.0, 2.0, 3.0, "h")],
                                  "page_id long, url string, features double, prediction double, rawPrediction double, HOST string")
    out = url_filter.judge(pages, trees=2)
    assert [c for c in out.columns if c.lower() == "host"] == ["host"] and {r.host for r in out.collect()} == {"x.net", "y.org"}
    from strata.llm import bpe, suffix_dedup
    docs = spark.createDataFrame([(1, "some text", 5, "x", "y", 1.0, "z")], "doc_id long, text string, N_BYTES int, IDS string, Decoded string, Score double, lang_pred string")
    assert suffix_dedup.dedup(docs).select("n_bytes").first()[0] == 9
    coded = bpe.decode(bpe.encode(docs))
    assert bytes(coded.first().decoded) == b"some text" and [c.lower() for c in coded.columns].count("ids") == 1
    assert language_id.predict(docs, None).first().lang_pred == "und"
