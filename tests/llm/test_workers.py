import pytest

import corpus_pipeline
from riboscan.llm.bloom import BlockedBloom
from riboscan.llm.core import Workspace, table
from riboscan.llm.quality import FEATURES, with_statistics


def workers(plan):
    """Python workers that a task of the plan's last stage holds at once, and the most of the stages before it."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return workers(plan.executedPlan())
    below = [workers(plan.children().apply(i)) for i in range(plan.children().size())]
    now, most = max((n for n, _ in below), default=0), max((m for _, m in below), default=0)
    if "Exchange" in name:
        return 0, max(now, most)
    return now + any(x in name for x in ("Arrow", "Pandas", "Python")), most


def most_workers(df):
    return max(workers(df._jdf.queryExecution().executedPlan()))


@pytest.mark.parametrize("at", range(len(corpus_pipeline.STAGES)))
def test_a_task_of_the_pipeline_holds_one_python_worker(spark, sf_dir, monkeypatch, at):
    seen, keep = [], Workspace.keep
    monkeypatch.setattr(Workspace, "keep", lambda self, df, name: seen.append(most_workers(df)) or keep(self, df, name))
    name, stage = corpus_pipeline.STAGES[at]
    seen.append(most_workers(stage(spark, table(spark, sf_dir, "documents"), sf_dir)))
    assert max(seen) == (0 if name == "packing" else 1), name


def test_statistics_of_known_rows_are_those_of_all(spark):
    rows = [(i % 50 or None, f"Some words, {i} of them. " * (i % 7)) for i in range(400)] + [(3, None), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bloom = BlockedBloom.of_ids(spark.createDataFrame([(3,), (7,), (9,)], "doc_id long"))
    line = lambda df: sorted(((r.doc_id or 0, r.text or "", *[r._stats[f] for f in FEATURES]) for r in df.collect()))
    got = with_statistics(docs, ["doc_id", "text"], known=bloom)
    assert line(got) == line(with_statistics(bloom.maybe(docs, "doc_id"), ["doc_id", "text"]))
    assert {3, 7, 9} <= {r.doc_id for r in got.collect()} and got.columns == ["doc_id", "text", "_stats"]
