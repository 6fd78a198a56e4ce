import random

import numpy as np
import pytest

from ticksmith.llm import ngram_join as nj

from .brute import SPACED, UPPER


def shingles(text, words=4):
    w = SPACED.findall((text or "").translate(UPPER))
    return {tuple(w[i : i + words]) for i in range(max(len(w) - words + 1, 1))} if w else set()


def brute(rows, words=4, percent=85):
    """(id, size, component) of (id, text) rows, None last in a component."""
    sets = [shingles(t, words) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            least[find(i)] = min(name, least.get(find(i), name))
    return [(name, len(sets[i]), least.get(find(i))) for i, (name, _) in enumerate(rows)]


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v) for v in r))


def result(frame):
    return order((r.doc_id, r.n_shingles, r.component_id) for r in frame.collect())


def test_equals_brute_force_on_the_tables(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert result(nj.near_copies(documents)) == order(brute(rows))


@pytest.mark.parametrize(("words", "percent"), [(4, 85), (2, 60), (1, 50), (3, 100)])
def test_equals_brute_force_around_the_threshold(spark, words, percent):
    """Chains of texts that drift apart, common words, short texts, copies and groups."""
    draw = random.Random(words * 100 + percent)
    rows = []
    for group in range(40):
        text = [f"w{draw.randrange(60 if group % 2 else 4000)}" for _ in range(draw.choice([3, 5, 8, 20, 60, 150]))]
        for _ in range(draw.choice([1, 2, 5, 20])):
            if draw.random() < 0.7:
                text = list(text)
                for _ in range(draw.choice([0, 1, 1, 2, 6])):
                    text[draw.randrange(len(text))] = f"x{draw.randrange(3000)}"
            rows.append((len(rows), " ".join(text)))
    rows += [(5000 + i, rows[i][1]) for i in range(0, len(rows), 7)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(nj.near_copies(frame, words=words, percent=percent)) == order(brute(rows, words, percent))


def test_a_large_group_of_near_copies_costs_no_pairs(spark):
    """Every text links with every other; the candidates grow with the group, not its square."""
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(1500):
        text = list(base)
        text[i % 190] = f"own{i}"
        rows.append((i + 10, " ".join(text)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = nj.near_copies(frame).collect()
    assert {r.component_id for r in found} == {10}


def test_odd_rows(spark, odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert result(nj.near_copies(odd)) == order(brute(rows))
    assert nj.near_copies(nothing).count() == 0
    only = odd.where("doc_id is null or text is null or text = ''")
    assert result(nj.near_copies(only)) == order(brute([(r.doc_id, r.text) for r in only.collect()]))


def test_levels_keep_every_similar_pair():
    """Prefixes at any level share that many n-grams if the sets are similar enough."""
    draw = np.random.default_rng(4)
    for _ in range(300):
        n = int(draw.integers(1, 60))
        one = set(draw.choice(90, n, replace=False).tolist())
        two = {x for x in one if draw.random() > 0.1} | set(draw.choice(90, 3).tolist())
        if not two or 100 * len(one & two) < 85 * len(one | two):
            continue
        least = nj.overlap(len(one), len(two), 85)
        assert least >= max(nj.required(len(one), 85), nj.required(len(two), 85))
        for level in range(1, 1 + min(least, nj.MAX_LEVEL)):
            prefix = [set(sorted(s)[: len(s) - least + level]) for s in (one, two)]
            assert len(prefix[0] & prefix[1]) >= level


def test_costly_lists_lengthen_the_prefix():
    rare, common = np.zeros(60), np.full(60, 1000.0)
    assert nj.chosen_level(rare, 300, 85) == 1
    assert nj.chosen_level(common, 300, 85) > 4
    assert nj.chosen_level(common[:2], 2, 85) <= 2
