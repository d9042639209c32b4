"""Ids that several texts share, in the stages that drop rows; the plan of the tree merge; thinned links."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from recallspark.llm.components import components, forest
from recallspark.llm.exact_dedup import tree_merge
from tests.llm.conftest import SMALL

KINDS = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], KINDS)


def words(name, n=60):
    return [f"{name}{i}" for i in range(n)]


def test_near_copies_keep_the_other_text_of_an_id(spark):
    a, clean = words("a"), " ".join(words("clean"))
    near, nearer = " ".join([*a[:-1], "other"]), " ".join([*a[:-2], "two", "more"])
    rows = [(2, " ".join(a)), (3, near), (3, clean), (3, clean), (4, None), (4, ""), (None, nearer), (5, nearer), (1, "unlike all others here now")]
    kept = sorted((r.doc_id or 0, r.text or "") for r in corpus_pipeline.near_copies(spark, table(spark, rows), SMALL).collect())
    assert kept == sorted([(2, " ".join(a)), (3, clean), (3, clean), (4, ""), (4, ""), (0, nearer), (1, "unlike all others here now")])


def test_near_copies_linked_through_a_row_without_id(spark):
    left = words("w", 100)
    middle, right = [*words("x", 12), *left[12:]], [*words("x", 12), *left[12:88], *words("y", 12)]
    rows = [(7, " ".join(left)), (None, " ".join(middle)), (8, " ".join(right)), (9, "one text"), (9, "another text")]
    kept = {r.doc_id for r in corpus_pipeline.near_copies(spark, table(spark, rows), SMALL).collect()}
    assert kept == {7, None, 9}


def test_leaks_keep_the_other_text_of_an_id(spark):
    item = max((r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()), key=len)
    rows = [(1, f"before {item} behind"), (1, "nothing of that sort in here"), (2, "and nothing here at all either"), (None, item)]
    kept = sorted((r.doc_id or 0, r.text) for r in corpus_pipeline.leaks(spark, table(spark, rows), SMALL).collect())
    assert kept == sorted([(1, rows[1][1]), (2, rows[2][1]), (0, item)])
    assert corpus_pipeline.leaks(spark, table(spark, rows[1:3]), SMALL).count() == 2


def test_tree_merge_sorts_and_does_not_hash(spark):
    runs = spark.createDataFrame([(0, "aa", 1, 1, 5, 1)], "run int, digest string, check long, length int, id long, copies long")
    plan = tree_merge(runs)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    # of each round of 64 runs, four at a time: one sort, one pass in order
    assert plan.count("Window [") >= 3 and plan.count("Sort [") >= 3 and "Aggregate" not in plan


@pytest.mark.parametrize("seed", [1, 2])
def test_thinned_links_connect_the_same(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(50)] + [(100 + i, 100 + p) for i in range(200) for p in (3, 50, 150, 199)]
    pairs += [(b, a) for a, b in pairs[::3]]
    parent = {x: x for p in pairs for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    edges = spark.createDataFrame(pairs, "a long, b long")
    got = {r.id: r.label for r in components(edges).collect()}
    assert got == {x: min(y for y in parent if root(y) == root(x)) for x in parent if any(x in p and p[0] != p[1] for p in pairs)}
    kept = forest(edges.coalesce(1)).collect()
    assert len(kept) == len(parent) - len({root(x) for x in parent})
