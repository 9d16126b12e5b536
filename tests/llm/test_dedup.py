"""Near-duplicate and substring operators against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from strata.llm import minhash_forest, repeats, substring_dedup, suffix_dedup
from strata.llm.common import chunks, text_bytes
from strata.llm.fm_index import FMIndex, suffix_array
from strata.llm.windows import segments, sliding_min

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
BYTE_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute_components(rows):
    sets = []
    for _, text in rows:
        w = WORDS.findall(lowered(text or ""))
        sets.append({tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    where = defaultdict(list)
    for k, s in enumerate(sets):
        for g in s:
            where[g].append(k)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, s in enumerate(sets):
        shared = Counter(o for g in s for o in where[g] if o > k)
        for o, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[o]) - n):
                parent[find(o)] = find(k)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return Counter((i, len(sets[k]), least.get(find(k)), i is not None and least.get(find(k)) == i) for k, (i, _) in enumerate(rows))


def brute_bytes(rows, width):
    seen = Counter()
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, t in texts:
        seen.update(t[j:j + width] for j in range(len(t) - width + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for j in range(len(t) - width + 1):
            if seen[t[j:j + width]] > 1:
                gone[j:j + width] = b"\1" * width
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((i, len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def brute_words(rows, width):
    last = 1 << 62
    least = {}
    texts = [(last if i is None else i, BYTE_WORDS.findall((t or "").encode())) for i, t in rows]
    for i, w in texts:
        for j in range(len(w) - width + 1):
            key = tuple(w[j:j + width])
            least[key] = min(least.get(key, last), i)
    out = []
    for i, w in texts:
        gone = [0] * len(w)
        for j in range(len(w) - width + 1):
            if least[tuple(w[j:j + width])] < i:
                gone[j:j + width] = [1] * width
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((None if i == last else i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("region", [1000, 2])
def test_components_match_brute_force(odd_docs, odd_rows, region):
    got = minhash_forest.components(odd_docs, region=region)
    assert Counter(map(tuple, got.collect())) == brute_components(odd_rows)


def test_one_link_between_two_large_components(spark):
    common, size = " ".join(f"c{i}" for i in range(63)), 1300
    tails = [" ".join(f"{side}{i}" for i in range(10)) for side in "xy"]
    texts = [f"{side}first{i} {common} {tail}" for side, tail in zip("xy", tails, strict=True) for i in range(size)]
    texts += [f"{word} {common} {tail}" for word in ("link",) for tail in tails]  # 60 of 80 shingles shared, all other pairs across 59 of 81
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["component_id"] for r in minhash_forest.components(docs).collect()} == {0}
    apart = minhash_forest.components(docs.where(f"doc_id < {2 * size}")).groupBy("component_id").count().collect()
    assert sorted(map(tuple, apart)) == [(0, size), (size, size)]


def test_components_of_nothing(no_docs):
    assert minhash_forest.components(no_docs).count() == 0


def test_contraction_joins_a_long_path(spark):
    edges = spark.createDataFrame([(hashlib.md5(b"%d" % i).digest(), hashlib.md5(b"%d" % (i + 1)).digest()) for i in range(120)], "a binary, b binary")
    labels = minhash_forest.contract(edges, None).collect()
    assert len(labels) == 121 and len({bytes(r["label"]) for r in labels}) == 1


@pytest.mark.parametrize("rest", [0, 40, 10_000])
def test_contraction_by_rounds_and_by_its_rest(spark, rest):
    name = lambda i: hashlib.md5(b"%d" % i).digest()
    pairs = [(i, i + 1) for i in range(0, 90)] + [(200, i) for i in range(201, 230)] + [(300, 301), (301, 302), (302, 300), (300, 301)]
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    edges = spark.createDataFrame([(name(i), name(j)) for i, j in pairs], "a binary, b binary").mapInArrow(counted, "a binary, b binary")
    labels = {bytes(r["node"]): bytes(r["label"]) for r in minhash_forest.contract(edges, None, rest=rest).collect()}
    assert seen.value == len(pairs)  # the edges, often whole joins and matrix products, are worked out once
    parts = [range(91), range(200, 230), range(300, 303)]
    assert len(labels) == sum(map(len, parts))
    assert [len({labels[name(i)] for i in part}) for part in parts] == [1, 1, 1] and len(set(labels.values())) == 3
    earlier = spark.createDataFrame([(k, v) for k, v in labels.items()], "node binary, label binary")
    more = spark.createDataFrame([(labels[name(0)], labels[name(200)]), (labels[name(200)], name(999))], "a binary, b binary")
    after = {bytes(r["node"]): bytes(r["label"]) for r in minhash_forest.contract(more, earlier, rest=rest).collect()}
    assert len(after) == len(labels) + 1 and len({after[name(i)] for i in (0, 90, 200, 229, 999)}) == 1 and after[name(300)] == after[name(302)] != after[name(0)]


def test_a_small_rest_needs_no_rounds(spark, monkeypatch):
    made, keep = [], minhash_forest.stage
    monkeypatch.setattr(minhash_forest, "stage", lambda df, name: made.append(name) or keep(df, name))
    edges = spark.createDataFrame([(b"%d" % i, b"%d" % (i + 1)) for i in range(3000)], "a binary, b binary")
    assert minhash_forest.contract(edges, None).select("label").distinct().count() == 1
    assert made == ["edges", "step", "labels"]


@pytest.mark.parametrize("options", [{}, {"hot": 2, "hot_pack": 2, "pack_bytes": 20_000}])
@pytest.mark.parametrize("width", [24, 200])
def test_byte_repeats_match_brute_force(odd_docs, odd_rows, width, options):
    rows = [r for r in odd_rows if len(r[1] or "") < 100_000]
    docs = odd_docs.where("text is null or length(text) < 100000")
    got = suffix_dedup.dedup(docs, width, **options)
    assert {"lang_pred", "n_words", "node"} <= set(got.columns)
    found = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got.collect())
    assert found == brute_bytes(rows, width)


@pytest.mark.parametrize("options", [{}, {"hot": 2, "hot_pack": 2, "pack_bytes": 20_000}])
@pytest.mark.parametrize("width", [7, 50])
def test_word_repeats_match_brute_force(odd_docs, odd_rows, width, options):
    got = substring_dedup.dedup(odd_docs, width, **options)
    found = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got.collect())
    assert found == brute_words(odd_rows, width)


def test_repeats_of_nothing(no_docs):
    assert suffix_dedup.dedup(no_docs).count() == 0 and substring_dedup.dedup(no_docs).count() == 0


def test_kept_text_is_what_is_left(spark):
    shared = "".join(chr(97 + i * 7 % 26) for i in range(230))
    docs = spark.createDataFrame([(1, "é" + shared + "tail"), (2, shared), (3, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r["left"] for r in suffix_dedup.dedup(docs, kept="left").collect()}
    assert rows == {1: "étail", 2: "", 3: None}


def test_sorted_windows_are_in_order():
    raw = np.random.default_rng(2).integers(97, 99, 4000).astype(np.uint8)
    raw[2000:2600] = raw[100:700]
    at = np.arange(len(raw) - 48)
    order, new = suffix_dedup.sort_windows(raw, at, 48, 8)
    text = raw.tobytes()
    found = [text[i:i + 48] for i in order]
    assert found == sorted(text[i:i + 48] for i in at)
    assert [a != b for a, b in zip(found[1:], found[:-1], strict=True)] == new[1:].tolist()


def test_byte_windows_are_settled_by_their_order(monkeypatch):
    """Every window that counts as repeated, of segments seen once, stood beside an equal one in the sorted order."""
    text = "".join(random.Random(4).choices("ab", k=3000)).encode()
    text += text[500:900] + b"x" + text[700:1000] + b"y" + text[500:640]
    op, raw = suffix_dedup.SuffixRepeats(60), np.frombuffer(text, np.uint8)
    found, _ = segments(*op.symbols(raw, np.array([0, len(raw)])), op.width, op.k)
    first = np.unique(np.stack([found.key, found.digest]), axis=1, return_index=True)[1]  # each distinct segment is sent once
    own = sorted(first.tolist(), key=lambda i: int(found.key[i]))
    sent = np.zeros(len(own), repeats.SENT)
    sent["key"], sent["n"] = found.key[own], 1
    spans = [(int(found.start[i]), int(found.count[i])) for i in own]
    contents = [raw[a:a + c + op.width - 1] for a, c in spans]
    beside, whole = [], suffix_dedup.sort_windows

    def counted(*args, **named):
        order, new = whole(*args, **named)
        beside.append(int((~new | np.append(~new[1:], False)).sum()))
        return order, new

    monkeypatch.setattr(suffix_dedup, "sort_windows", counted)
    values = op.resolve(sent, contents)
    windows = [bytes(c[i:i + op.width]) for c in contents for i in range(len(c) - op.width + 1)]
    times = Counter(windows)
    assert np.concatenate(values).tolist() == [min(times[w], 2) for w in windows]
    assert sum(beside) == sum(times[w] > 1 for w in windows) > 0


def test_segments_of_a_mixed_minimizer_wait_for_the_order():
    records = np.zeros(3, repeats.RECORD)
    records["key"], records["digest"], records["n"] = 7, [1, 1, 2], [4, 4, 1]
    answers, _ = repeats.count_records(records, np.arange(3), 5000)
    assert not (answers["code"] & repeats.VALUE).any() and (answers["code"] & repeats.WANT).all()
    assert (answers["code"] & repeats.SHIP > 0).sum() == 2


def test_equal_windows_share_minimizers():
    rng = np.random.default_rng(3)
    symbols = rng.integers(0, 1 << 60, 400).astype(np.uint64)
    symbols[250:330] = symbols[20:100]
    found, _ = segments(symbols, np.array([0, 200, 200, 400]), 50, 8)
    key_of = {int(s) + d: int(k) for k, s, c in zip(found.key, found.start, found.count, strict=True) for d in range(c)}
    assert sorted(key_of) == [*range(151), *range(200, 351)]
    assert all(key_of[20 + d] == key_of[250 + d] for d in range(31))
    assert (sliding_min(symbols, 7) == [symbols[i:i + 7].min() for i in range(394)]).all()


def test_fm_index_finds_all_occurrences():
    rng = np.random.default_rng(5)
    for _ in range(40):
        seq = rng.integers(1, 5, int(rng.integers(1, 120)))
        index = FMIndex(seq, 5, sample=int(rng.integers(1, 9)))
        lengths = rng.integers(1, 6, 20)
        patterns = rng.integers(1, 5, (20, 6))
        low, high = index.search(patterns, lengths)
        for k, n in enumerate(lengths):
            p = patterns[k, 6 - n:]
            want = [i for i in range(len(seq) - n + 1) if (seq[i:i + n] == p).all()]
            assert sorted(index.locate(np.arange(low[k], high[k])).tolist()) == want
    seq = np.append(np.tile([2, 1], 50), 0)
    assert (suffix_array(seq) == sorted(range(101), key=lambda i: seq[i:].tolist())).all()


def test_chunks_cover_all_rows():
    import pyarrow as pa
    raw, offsets = text_bytes(pa.array(["ab", None, "", "çd" * 10, "x"]))
    assert raw.tobytes().decode() == "ab" + "çd" * 10 + "x"
    assert [r for i, j in chunks(offsets, 4) for r in range(i, j)] == [0, 1, 2, 3, 4]


def thue_morse(a, b, n=1024):
    """Two words of n letters that every polynomial hash mod 2**64 takes for one: the Thue-Morse word and its complement."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join((a, b)[i] for i in bits), "".join((b, a)[i] for i in bits)


@pytest.mark.parametrize("letters", ["ab", "'u", "éä"])
def test_words_that_polynomials_confuse_stay_apart(spark, letters):
    one, two = thue_morse(*letters)
    lead = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*lead[:49], w])) for i, w in enumerate((one, two))] + [(i + 2, f"{w} b c d e") for i, w in enumerate((one, two))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in substring_dedup.dedup(docs).collect()}
    assert all(r.n_removed == 0 for r in found.values())
    near = {r.doc_id: r.component_id for r in minhash_forest.components(docs.where("doc_id > 1")).collect()}
    assert near == {2: 2, 3: 3}
