import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticksmith.llm import suffix_dedup
from ticksmith.llm.automaton_dedup import Automaton, remove_repeated_words
from ticksmith.llm.queries import QUERIES
from ticksmith.llm.suffix_dedup import remove_repeated_bytes, two_stage_order

from . import brute
from .conftest import SF


def _bytes(text):
    return (text or "").encode()


def test_byte_query_against_brute_force(spark, documents):
    rows = {r.doc_id: r for r in QUERIES["op4_suffix_dedup"](spark, SF).collect()}
    docs = documents.collect()
    raw = [_bytes(d.text) for d in docs]
    removed = 0
    for d, text, gone in zip(docs, raw, brute.repeated_units(raw, 400), strict=True):
        r = rows[d.doc_id]
        spans = sum(1 for i in gone if i - 1 not in gone)
        kept = bytes(b for i, b in enumerate(text) if i not in gone)
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(text), len(gone), spans)
        assert r.kept_sha256 == brute.sha(kept)
        removed += len(gone)
    assert removed


def test_word_query_against_brute_force(spark, documents):
    rows = {r.doc_id: r for r in QUERIES["op7_automaton_dedup"](spark, SF).collect()}
    docs = documents.collect()
    words = [tuple(brute.SPACED.findall(d.text or "")) for d in docs]
    removed = 0
    for d, own, gone in zip(docs, words, brute.repeated_units(words, 35), strict=True):
        r = rows[d.doc_id]
        kept = " ".join(w for i, w in enumerate(own) if i not in gone)
        assert (r.n_words, r.n_removed, r.kept_sha256) == (len(own), len(gone), brute.sha(kept))
        removed += len(gone)
    assert removed


def _planted(seed, letters):
    """Texts that share passages, copies, runs of one unit and periods."""
    draw = random.Random(seed)
    some = lambda n: [draw.choice(letters) for _ in range(n)]
    passages = [some(n) for n in (11, 12, 13, 40)]
    rows = []
    for _ in range(40):
        row = some(draw.randint(0, 30))
        for _ in range(draw.randint(0, 3)):
            row += draw.choice(passages) + some(draw.randint(0, 9))
        rows.append(row)
    rows += [rows[5], rows[6], rows[6], [letters[0]] * 60, some(2) * 30, some(3) * 11, passages[0]]
    return rows


@pytest.mark.parametrize("hot", [2000, 1])
def test_planted_bytes(spark, hot):
    for seed in (1, 2):
        texts = ["".join(r) for r in _planted(seed, ["a", "b", "é", "\n"])]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        found = remove_repeated_bytes(docs, window=12, gram=4, hot_contexts=hot, chunk_bytes=300)
        found = {r.doc_id: r for r in found.collect()}
        raw = [_bytes(t) for t in texts]
        for i, gone in enumerate(brute.repeated_units(raw, 12)):
            assert {b for s in found[i].spans for b in range(s.start, s.end)} == gone
            assert bytes(found[i].kept) == bytes(b for k, b in enumerate(raw[i]) if k not in gone)


@pytest.mark.parametrize("hot", [2000, 1])
def test_planted_words(spark, hot):
    for seed in (3, 4):
        rows = _planted(seed, ["x", "Y", "ü", "zz", "w"])
        docs = spark.createDataFrame(
            [(i, "  ".join(r)) for i, r in enumerate(rows)], "doc_id long, text string"
        )
        found = remove_repeated_words(docs, window=12, gram=4, hot_contexts=hot, chunk_bytes=300)
        found = {r.doc_id: r for r in found.collect()}
        for i, gone in enumerate(brute.repeated_units([tuple(r) for r in rows], 12)):
            assert {w for s in found[i].spans for w in range(s.start, s.end)} == gone
            assert found[i].kept == " ".join(w for k, w in enumerate(rows[i]) if k not in gone)


def test_two_stage_order_is_the_suffix_order():
    draw = random.Random(8)
    for size in (0, 1, 2, 50, 400):
        for letters in (b"a", b"ab", b"abcd\x00\xfe"):
            text = bytes(draw.choice(letters) for _ in range(size))
            assert two_stage_order(text, size + 1).tolist() == sorted(
                range(size), key=lambda i, t=text: t[i:]
            )


def test_common_prefixes_stop_at_the_end():
    starts = suffix_dedup.repeated_starts([b"x" * 30, b"y" * 9, b"x" * 12], [False] * 3, 12)
    assert [s.tolist() for s in starts] == [list(range(19)), [], [0]]


def test_automaton_counts_places():
    shard = Automaton()
    for word, weight in (("abcbc", 1), ("bcb", 1), ("zz", 2)):
        shard.add(list(word), weight)
    shard.finish()
    assert shard.matches(list("abcbc")) == [0, 1, 2, 3, 2]
    assert shard.matches(list("zz")) == [1, 2]


def test_odd_rows(odd, nothing):
    for remove in (
        lambda d: remove_repeated_bytes(d, window=20, gram=8),
        lambda d: remove_repeated_words(d, window=5, gram=4),
    ):
        rows = remove(odd).collect()
        assert len(rows) == odd.count()
        six = [r for r in rows if r.doc_id == 6]
        assert len(six) == 2
        assert all(len(r.kept) == 0 and r.text for r in six)
        assert all(r.spans == [] for r in rows if r.doc_id in (1, 2, 3, 10))
        assert all(r.spans == [] for r in rows if r.doc_id is None or r.doc_id == 9)
        assert all(r.spans for r in rows if r.doc_id == 8)
        assert remove(nothing).count() == 0
    assert odd.where(F.col("doc_id") == 4).count() == 1


def test_a_long_text_is_cut_into_slices(spark, monkeypatch):
    from ticksmith.llm import repeats

    draw = random.Random(4)
    part = "".join(draw.choice("abcdef") for _ in range(900))
    text = part + "".join(draw.choice("ghijkl") for _ in range(900)) + part[100:500]
    monkeypatch.setattr(repeats, "_SLICE", 64)
    units = suffix_dedup._bytes(np.frombuffer(text.encode(), "u1"), np.array([0, len(text)]))
    method = repeats.Method(30, 8, None, None, None, 0)
    starts = []
    for _, start, count, _ in repeats._sliced(units, method):
        for s, n in zip(start.tolist(), count.tolist(), strict=True):
            starts += range(s, s + n)
    assert starts == list(range(len(text) - 29))


def test_thousands_of_rows_equal_in_id_and_text(spark):
    text = " ".join(f"word{i % 180}" for i in range(600))
    own = " ".join(f"own{i}" for i in range(80))
    rows = [(None, text)] * 5000 + [(7, own), (8, own + " end")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    began = time.monotonic()
    words = remove_repeated_words(frame).select("doc_id", "kept", "spans").collect()
    letters = remove_repeated_bytes(frame).select("doc_id", "spans").collect()
    assert time.monotonic() - began < 90
    assert len(words) == len(letters) == len(rows)
    assert {r.doc_id: r.kept for r in words} == {None: "", 7: "", 8: "end"}
    # The copies repeat in whole; the other two share all but the end.
    ends = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in letters}
    assert ends == {None: [(0, len(text))], 7: [(0, len(own))], 8: [(0, len(own))]}


def _near_copies(letters, copies, seed):
    """Texts that differ in one unit each from a long one, whose anchors they share, and a few
    that hold a part of it."""
    draw = random.Random(seed)
    some = lambda n: [draw.choice(letters) for _ in range(n)]
    base = some(160)
    rows = []
    for _ in range(copies):
        at = draw.randrange(len(base))
        rows.append([*base[:at], draw.choice(["q", "v"]), *base[at + 1 :]])
    rows += [some(9) + base[40:90] + some(9), base[:40], base, base, some(70)]
    return rows


@pytest.mark.parametrize("hot", [1, 20])
def test_anchors_of_many_contexts_against_brute_force(spark, hot):
    rows = _near_copies(["x", "Y", "zz", "w", "k"], 200, 9)
    docs = spark.createDataFrame([(i, " ".join(r)) for i, r in enumerate(rows)], "doc_id long, text string")
    for remove, units, window in (
        (remove_repeated_words, [tuple(r) for r in rows], 35),
        (remove_repeated_bytes, [" ".join(r).encode() for r in rows], 100),
    ):
        found = remove(docs, window=window, gram=4, hot_contexts=hot, chunk_bytes=3000)
        found = {r.doc_id: r for r in found.collect()}
        for i, gone in enumerate(brute.repeated_units(units, window)):
            assert {u for s in found[i].spans for u in range(s.start, s.end)} == gone


@pytest.mark.parametrize("module", ["suffix_dedup", "automaton_dedup"])
def test_contexts_of_a_busy_anchor_come_through_the_method(spark, monkeypatch, module):
    from ticksmith.llm import automaton_dedup, repeats

    module = {"suffix_dedup": suffix_dedup, "automaton_dedup": automaton_dedup}[module]
    rows = _near_copies(["x", "Y", "zz", "w", "k"], 100, 5)
    docs = spark.createDataFrame([(i, " ".join(r)) for i, r in enumerate(rows)], "doc_id long, text string")
    tables = []

    def written(frame, name):
        tables.append((name, repeats_written(frame, name)))
        return tables[-1][1]

    repeats_written = repeats.written
    monkeypatch.setattr(repeats, "written", written)
    none = lambda payloads, many, window: [np.zeros(0, dtype=np.int64) for _ in payloads]
    monkeypatch.setattr(module, "repeated_starts", none)
    remove = remove_repeated_bytes if module is suffix_dedup else remove_repeated_words
    # What the method does not find is found by nothing else.
    found = remove(docs, window=35, gram=4, hot_contexts=20)
    assert found.where(F.size("spans") > 0).count() == 0
    # A round makes a few rows of a busy context, not one for each of its windows.
    hot = [frame for name, frame in tables if name == "hot"]
    made = [frame for name, frame in tables if name == "contexts"]
    units = F.length("text") if module is suffix_dedup else F.size(F.split(F.col("text").cast("string"), " "))
    windows = hot[0].select(F.sum((units - 34) * F.col("stands"))).first()[0]
    assert hot[0].count() > 20
    assert made[1].count() < windows / 2


def test_rolling_hashes_of_any_width():
    from ticksmith.llm.shared import rolling

    draw = random.Random(2)
    values = np.array([draw.randrange(3) for _ in range(400)])
    for width in (1, 3, 8, 13, 395, 400, 401):
        hashes = rolling(values, width).tolist()
        plain = [tuple(values[i : i + width].tolist()) for i in range(len(values) - width + 1)]
        assert len(hashes) == len(plain)
        assert len(set(zip(hashes, plain, strict=True))) == len(set(plain)) == len(set(hashes))
