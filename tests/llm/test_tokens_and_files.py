"""Byte-level BPE, token files, piecewise hashes and archives against the libraries and exact round trips."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from strata.llm import bpe, fuzzy, pretokens, token_store, warc
from strata.llm.common import stage


@pytest.fixture(scope="module")
def tiktoken_ids():
    import tiktoken
    ranks = {t: i for i, t in enumerate(bpe.read_ranks(bpe.VOCABULARY))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@pytest.fixture(scope="module")
def library_ids():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(token_store.VOCABULARY)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def odd_texts(n=1500):
    rng = random.Random(1)
    parts = list("ab1 \n\t'sé漢\x85\xa0　\x1c​😀<|>.,½Ⅷ") + [" ", "  ", "'ll", "ing", " the", ".\n", " \n"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(n)]


def test_ids_equal_the_libraries(tiktoken_ids, library_ids):
    texts = odd_texts()
    column = pa.array(texts)
    ours = bpe.codec(bpe.VOCABULARY, public_tokenizers.PATTERN)
    first = ours.encode(column)
    second = token_store.tokens(token_store.VOCABULARY, public_tokenizers.PATTERN).encode(column)
    for text, a, b in zip(texts, first.to_pylist(), second.to_pylist(), strict=True):
        assert np.frombuffer(a, "<u4").tolist() == tiktoken_ids(text), text
        assert np.frombuffer(b, "<u4").tolist() == library_ids(text), text
    assert ours.decode(first).to_pylist() == [t.encode() for t in texts]


def test_every_code_point_is_cut_as_the_libraries_do(tiktoken_ids, library_ids):
    rare = set(pretokens.stand_ins(public_tokenizers.PATTERN))
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % 97 == 0 or c in rare)]
    texts = [f"a{chr(c)}'s b" for c in points]
    first = bpe.codec(bpe.VOCABULARY, public_tokenizers.PATTERN).encode(pa.array(texts)).to_pylist()
    second = token_store.tokens(token_store.VOCABULARY, public_tokenizers.PATTERN).encode(pa.array(texts)).to_pylist()
    assert first == second
    assert 0x558 in rare and len(rare) > 10_000
    for text, a in zip(texts, first, strict=True):
        got = np.frombuffer(a, "<u4").tolist()
        assert got == tiktoken_ids(text) == library_ids(text), text


def test_rare_code_points_among_words(tiktoken_ids, library_ids):
    rng = random.Random(2)
    parts = [chr(c) for c in (0x558, 0x88F, 0xC5C, 0x208F, 0xA7CE, 0x107BB)] + list("ab1 \n\té½.'") + ["'ll", " the", "  "]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(2000)]
    first = bpe.codec(bpe.VOCABULARY, public_tokenizers.PATTERN).encode(pa.array(texts)).to_pylist()
    second = token_store.tokens(token_store.VOCABULARY, public_tokenizers.PATTERN).encode(pa.array(texts)).to_pylist()
    for text, a, b in zip(texts, first, second, strict=True):
        assert np.frombuffer(a, "<u4").tolist() == tiktoken_ids(text) and np.frombuffer(b, "<u4").tolist() == library_ids(text), text


@pytest.mark.parametrize("pattern", [r"\s+|\S+", r"(a|th)e?|\p{Lu}\p{Ll}*|.", r"\w+|\W"])
def test_other_patterns(pattern):
    import tiktoken
    theirs = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(bpe.read_ranks(bpe.VOCABULARY))}, special_tokens={})
    texts = [*odd_texts(300), "the cat, Überall  \u0558x \u0c5c's", ""]
    got = bpe.codec(bpe.VOCABULARY, pattern).encode(pa.array(texts)).to_pylist()
    assert [np.frombuffer(v, "<u4").tolist() for v in got] == list(map(theirs.encode_ordinary, texts))


def test_memo_limit_changes_nothing(tiktoken_ids):
    made = bpe.ByteBPE(bpe.VOCABULARY, public_tokenizers.PATTERN)
    made.pieces.memo = pretokens.Memo(3, 4)
    texts = ["the cat sat on the mat, the end", "cat the mat"]
    for _ in range(2):
        assert [np.frombuffer(v, "<u4").tolist() for v in made.encode(pa.array(texts)).to_pylist()] == list(map(tiktoken_ids, texts))


def test_round_trip_query(odd_docs, odd_rows, tiktoken_ids):
    want = Counter()
    for i, text in odd_rows:
        ids = tiktoken_ids(text or "")
        want[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert Counter(map(tuple, bpe.round_trip(odd_docs).collect())) == want


def test_encode_and_decode_columns(odd_docs, no_docs):
    rows = bpe.decode(bpe.encode(odd_docs)).collect()
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in rows) and rows[0]["lang_pred"] == "x"
    assert bpe.round_trip(no_docs).count() == 0


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_planes_round_trip(planes):
    for ids in (np.array([0], "<u4"), np.arange(0, 70_000, 7, dtype="<u4"), np.array([2**32 - 1, 1], "<u4")):
        assert (token_store.from_planes(token_store.to_planes(ids, planes), len(ids), planes) == ids).all()


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_token_files(spark, odd_docs, odd_rows, library_ids, tmp_path, planes):
    manifest = token_store.write_ids(odd_docs, f"file://{tmp_path}", partitions=3, block=500, planes=planes)
    got = token_store.read_ids(manifest).orderBy("start").collect()
    at = 0
    for (i, text), row in zip(sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())), got, strict=True):
        ids = np.array([*library_ids(text or ""), 0], "<u4")
        assert tuple(row) == (i, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    paths = [r["path"] for r in manifest.collect()]
    reader = token_store.Reader(paths[0])
    assert sum(len(reader.block(k)) for k in reversed(range(len(reader.footer["blocks"])))) == int(reader.documents()[2].sum())


def test_token_query_equals_the_library_on_added_tokens(spark, tmp_path):
    from tokenizers import Tokenizer

    from strata.llm.queries import op10_token_files
    end = "<|endoftext|>"
    texts = [end, f"one {end} two", f"{end}{end} ", f"a<|endof{end}text|>b", f"  {end}\n\n x", "plain text", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    encode = Tokenizer.from_file(token_store.VOCABULARY).encode
    got = {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in op10_token_files(spark, str(tmp_path)).collect()}
    for i, text in enumerate(texts):
        ids = np.array([*encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        assert got[i] == (len(ids), zlib.crc32(ids.tobytes())), text


def test_token_files_of_nothing(no_docs):
    assert token_store.store_and_read(no_docs).count() == 0


M32, M64 = (1 << 32) - 1, (1 << 64) - 1


def mixed(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & M64
    x = (x ^ x >> 27) * 0x94D049BB133111EB & M64
    return x ^ x >> 31


def plain_fingerprint(text):
    """The definition byte by byte: no shared sums, no other text beside it."""
    symbol = [mixed(b + 1) for b in text]
    block = 8
    while block * 64 < len(text):
        block *= 2
    signatures = []
    for size in (block, 2 * block):
        out, begin = "", 0
        for i in range(len(text)):
            rolled = sum(pow(0x2C1B3C6D, k, 1 << 32) * (symbol[i - k] & M32 | 1) for k in range(7)) & M32 if i >= 6 else None
            cut = rolled is not None and ((rolled ^ rolled >> 15) * 0x297A2D39 & M32) >> 9 & size - 1 == 0
            if cut or i == len(text) - 1:
                value, power = (i + 1 - begin) * 0xD1B54A32D192ED03, 1
                for s in symbol[begin:i + 1]:
                    value, power = value + s * power, power * 0x9E3779B97F4A7C15 & M64
                out, begin = out + "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"[mixed(value & M64) & 63], i + 1
        signatures.append(out)
    return (block, *signatures)


def plain_likeness(x, y):
    def alike(a, b):
        if a == b:
            return 1.0
        run = min(4, len(a), len(b))
        if not run or not any(a[i:i + run] in b for i in range(len(a) - run + 1)):
            return 0.0
        return 1 - (len(a) + len(b) - 2 * longest_common(a, b)) / (len(a) + len(b))

    if x == y:
        return 1.0
    shared = [alike(a, b) for k, a in enumerate(x[1:]) for j, b in enumerate(y[1:]) if x[0] << k == y[0] << j]
    return max(shared, default=0.0)


def brute_fuzzy(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    texts, marks = [t or "" for _, t in order], {}
    mark = lambda t: marks.setdefault(t, None) or marks.__setitem__(t, plain_fingerprint(t.encode())) or marks[t]
    for k, (i, _) in enumerate(order):
        text, after = texts[k], texts[(k + 1) % len(texts)]
        third = len(text) // 3
        changed = text[:len(text) - third] + after[:third]
        a, b, c = mark(text), mark(changed), mark(after)
        yield (i, len(text), hashlib.sha256(changed.encode()).hexdigest(), "%d:%s:%s" % a, "%d:%s:%s" % b,
               round(plain_likeness(a, b), 12), round(plain_likeness(a, c), 12))


@pytest.mark.parametrize("partitions", [1, 4])
def test_fingerprints_in_order(odd_docs, odd_rows, partitions):
    got = [(*r[:5], round(r[5], 12), round(r[6], 12)) for r in fuzzy.compare_in_order(odd_docs, partitions).collect()]
    assert Counter(got) == Counter(brute_fuzzy(odd_rows))


def test_a_frequent_doc_id_is_split(spark, monkeypatch):
    from pyspark.sql import functions as F
    rows = [(None, "the same text again")] * 300 + [(7, "the same text again")] * 300 + [(i, f"text {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    staged = []
    monkeypatch.setattr(fuzzy, "stage", lambda d, name: staged.append(stage(d, name)) or staged[-1])
    out = fuzzy.compare_in_order(df, 6)
    tasks = {r.part: r.n for r in staged[0].where("role = 'first'").groupBy("part").agg(F.count("*").alias("n")).collect()}
    assert len(tasks) == 6
    got = out.collect()
    assert len(got) == 900 and {r.near_next for r in got if r.doc_id is None} == {1.0, fuzzy.likeness(*fuzzy.fingerprints([b"the same text again", b"text 299"]))}


def test_fingerprints_of_few(spark, no_docs):
    assert fuzzy.compare_in_order(no_docs).count() == 0
    (one,) = fuzzy.compare_in_order(spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")).collect()
    assert one["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and one["near_next"] == 1.0


def test_likeness_falls_with_edits():
    rng = random.Random(2)
    text = bytes(rng.randrange(97, 123) for _ in range(6000))
    other = bytes(rng.randrange(97, 123) for _ in range(6000))
    near = text[:3000] + b"inserted" + text[3000:]
    base, close, far = fuzzy.fingerprints([text, near, other])
    assert fuzzy.likeness(base, base) == 1 and fuzzy.likeness(base, close) > 0.9 and fuzzy.likeness(base, far) == 0


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


def test_common_length_is_the_edit_distance():
    rng = random.Random(3)
    for _ in range(100):
        a, b = ("".join(rng.choices("abcd", k=rng.randint(1, 80))) for _ in range(2))
        assert fuzzy.common_length(a, b) == longest_common(a, b)


def test_archives(spark):
    pages = [(1, "http://a", "same"), (2, None, "same"), (9, "http://b\r\nc", "same"), (3, "u", None), (4, "u", ""), (None, "u", "alone"),
             (None, "u", "same"), (5, "u", "ü" * 90_000), (5, "u", "ü" * 90_000), (6, "x", "WARC/1.1\r\n\r\n")] + [(100 + i, "v", f"<p>{i}</p>" * 50) for i in range(40)]
    df = spark.createDataFrame([(*p, 0) for p in pages], "page_id long, url string, html string, best int").repartition(3)
    largest = {}
    for i, _, h in pages:
        if i is not None:
            largest[h or ""] = max(largest.get(h or "", i), i)
    want = Counter()
    for i, _, h in pages:
        raw, win = (h or "").encode(), largest.get(h or "")
        again = win is not None and win != i
        want[i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", win if again else None] += 1
    for options in ({}, {"archive_bytes": 1, "sample_bytes": 1}):
        assert Counter(map(tuple, warc.archive_and_read(df, **options).collect())) == want
    assert warc.archive_and_read(df.limit(0)).count() == 0


def test_small_payloads_are_never_revisits(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    got = {r["page_id"]: r["record_type"] for r in warc.archive_and_read(df, min_payload=3).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}
