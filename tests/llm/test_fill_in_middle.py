"""Fill-in-middle: the cut tree against a plain scan, the query against its SQL, odd rows."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.compare import compare, connect
from recallspark.llm.fill_in_middle import CutTree, check_marks, draws, fill_in_middle, line_ends, restored, transform
from tests.llm.conftest import ODD, SMALL


def brute(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) by lists of lines."""
    units, digest = re.findall(r"[^\n]*\n|[^\n]+", text), hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 50:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("block", [1, 3, 7, 64, 4096])
def test_cuts_of_every_unit(block):
    rng = random.Random(block)
    for size in (0, 1, 2, 5, 50, 700):
        text = "".join(rng.choice("aé€𝄞\n\n ") for _ in range(size))
        data = np.frombuffer(text.encode(), np.uint8)
        tree = CutTree(data, line_ends(data), block)
        units = re.findall(r"[^\n]*\n|[^\n]+", text)
        assert (tree.units, tree.chars) == (len(units), len(text))
        for k in range(len(units) + 1):
            head = "".join(units[:k])
            assert tree.cut(k) == (len(head.encode()), len(head))


def test_other_units_and_rates():
    def every_byte(data):
        return np.ones(len(data), bool)
    assert transform("abcdef", (2, 4, 0, 99), unit_ends=every_byte)[-1] == "<P>ab<S>ef<M>cd"
    assert transform("abcdef", (4, 2, 0, 0), unit_ends=every_byte)[-1] == "<S>ef<P>ab<M>cd"
    assert transform("abcdef", (4, 2, 30, 0), rate=30)[1:] == ("plain", None, None, "abcdef")
    check_marks(("[a]", "[b]", "[c]"))
    for marks in (("aa", "b", "c"), ("<P><", "<S>", "<M>"), ("x", "x", "y"), ("", "x", "y")):
        with pytest.raises(ValueError):
            check_marks(marks)


def test_query_equals_sql_and_brute_force(spark, small_texts):
    query = entry.queries()["op11_fill_in_middle"]
    problem, rows = compare(spark, connect(SMALL), query, entry.oracle_sql()["op11_fill_in_middle"], SMALL)
    assert problem is None and rows == len(small_texts)
    for r in query(spark, SMALL).collect():
        n, form, prefix, middle, output = brute(r.doc_id, small_texts[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle)
        assert r.output_sha256 == hashlib.sha256(output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(small_texts[r.doc_id].encode()).hexdigest()


def test_odd_rows(spark, odd, none):
    lines = [(20, "a\n\nb\r\n\n"), (21, "\n"), (22, "\n\n\n"), (23, "no <M> here\nat all"), (24, "tail <\nS>P>\n<"), (25, "é€𝄞\n" * 40_000)]
    rows = [(r[0], r[1]) for r in ODD] + lines
    got = fill_in_middle(odd.select("doc_id", "text").unionByName(spark.createDataFrame(lines, "doc_id long, text string")))
    got = got.withColumn("back", restored(F.col("form"), F.col("output"))).collect()
    assert sorted(map(repr, (tuple(r)[:6] for r in got))) == sorted(repr((i, *brute(i, t or ""))) for i, t in rows)
    assert sorted(r.back for r in got) == sorted(t or "" for _, t in rows)
    assert fill_in_middle(odd).count() == len(ODD) and fill_in_middle(none).count() == 0
    assert draws(7, None) != draws(7, 0) != draws(8, 0)
