"""End to end on files: train + rank, evaluate, compare (the reference's three entry points)."""

import os
import tempfile

import pytest

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")


@pytest.mark.parametrize("task", [1, 2, 3])
def test_rank_evaluate_compare(spark, task):
    from ordo.cli import compare_files, evaluate_files, rank_files
    d = tempfile.mkdtemp(prefix="ordo-cli-")
    sig, rel = os.path.join(FIXTURES, "signal.txt"), os.path.join(FIXTURES, "rel.txt")
    idf = os.path.join(FIXTURES, "idf.csv")
    info = rank_files(spark, sig, rel, idf, sig, d + "/ranked", task=task, idf_format="csv")
    assert info["train_queries"] == 2
    ev = evaluate_files(spark, d + "/ranked", rel, report=d + "/report")
    assert ev["n_queries"] == 2 and 0.0 <= ev["mean_ndcg"] <= 1.0
    cmp = compare_files(spark, d + "/report", d + "/report")
    assert cmp["diff"] == 0.0 and cmp["color"] == "black"
