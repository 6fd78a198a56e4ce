import random
import re

from helpers import plan
from pyspark.sql import functions as F

from ticksmith.llm.components import components
from ticksmith.llm.queries import QUERIES
from ticksmith.llm.shared import written
from ticksmith.llm.simhash import keep_one, linked_fingerprints, near_duplicates

from . import brute
from .conftest import SF


def test_query_against_brute_force(spark, documents):
    rows = {r.doc_id: r for r in QUERIES["op9_simhash"](spark, SF).collect()}
    prints = [(r.doc_id, brute.simhash(r.text)) for r in documents.collect()]
    assert {i: r.fingerprint for i, r in rows.items()} == {i: f"{p:016x}" for i, p in prints}
    groups = brute.grouped(prints)
    assert [rows[i].component_id for i, _ in prints] == groups
    assert len(set(groups)) < len(groups)


def test_every_link_of_three_bits_and_none_of_four(spark):
    draw = random.Random(5)
    prints = {draw.getrandbits(64) for _ in range(30)} | {0, 2**64 - 1}
    for p in list(prints):
        for _ in range(6):
            prints.add(p ^ sum(1 << b for b in draw.sample(range(64), draw.randint(1, 5))))
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    found = linked_fingerprints(spark.createDataFrame(signed, "fingerprint long")).collect()
    unsigned = {frozenset((r.u % 2**64, r.v % 2**64)) for r in found}
    wanted = {frozenset((a, b)) for a in prints for b in prints if 0 < (a ^ b).bit_count() <= 3}
    assert unsigned == wanted


def test_balls_are_not_broadcast(spark):
    # A table so small that Spark would broadcast it, and its balls with it.
    prints = written(spark.range(100).select(F.xxhash64("id").alias("fingerprint")), "prints")
    assert "Broadcast" not in plan(linked_fingerprints(prints))


def test_written_fingerprints_are_not_broadcast(spark):
    rows = spark.range(100).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    assert re.search(r"\w+Join", plan(near_duplicates(written(rows, "docs")))).group() == "SortMergeJoin"


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, j) for j in range(101, 140)]
    edges += [(200, 201), (201, 202), (202, 200), (300, 300)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == (
        {i: 0 for i in range(61)} | {j: 100 for j in range(100, 140)} | {j: 200 for j in (200, 201, 202)}
    )


def test_odd_rows(odd, nothing):
    rows = near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r.component_id for r in rows}
    assert by_id[1] == by_id[2] == by_id[10] == 1  # no words: fingerprint zero
    assert by_id[4] == by_id[5] == by_id[6] == 4
    assert by_id[None] is None
    kept = keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 3, 4, None, 8, 9]))
    assert near_duplicates(nothing).count() == keep_one(nothing).count() == 0


def test_repeated_rows_count_once(odd):
    six = odd.where(F.col("doc_id") == 6)
    assert keep_one(six).count() == 1


def test_keep_one_without_ids_and_with_repeated_ids(spark):
    near = "x y z u v w"
    rows = [
        (None, near), (7, near), (None, "only a nameless text of its own kind"),
        (None, "only a nameless text of its own kind"), (1, "first text of the id one"),
        (1, "quite another text for the same id one"), (1, near), (5, "first text of the id one"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted(((r.doc_id, r.text) for r in keep_one(frame).collect()), key=str)
    assert kept == sorted([
        (1, near), (1, "first text of the id one"), (1, "quite another text for the same id one"),
        (None, "only a nameless text of its own kind"),
    ], key=str)
