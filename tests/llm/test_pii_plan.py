"""The plan of found personal data doesn't hold the trees that scored it."""
from shopscope.llm.pii import personal_data


def test_no_later_plan_holds_the_trees(spark):
    docs = spark.createDataFrame([(i, f"call me at 0171-555-01{i}9-2 or mail bob{i} (at) example (dot) org, tel 212.555.01{i}7") for i in range(10)], "doc_id long, text string")
    _, spans = personal_data(docs)
    plan = spans._jdf.queryExecution().optimizedPlan().toString()  # noqa: SLF001
    assert spans.count() >= 10 and "regexp_replace" not in plan and len(plan) < 10_000
