import pytest
from pyspark.sql import functions as F

from tidewater.plans.actions import ReviewQueue
from tidewater.plans.governance import band
from tidewater.staging import place

PROPOSALS = "action_id string, run_id string, agent string, account_id string, account_name string, priority string, action_type string, signal string, diagnosis string, draft string, status string"


def proposals(spark, *rows):
    return spark.createDataFrame([(i, run, "collections", acc, f"Account {acc}", p, kind, signal, f"- risk_tier: {signal}", f"draft for {acc}", "pending") for i, run, acc, p, kind, signal in rows], PROPOSALS)


def test_proposals_are_kept_decided_and_recalled(spark):
    at = place(spark)
    queue = ReviewQueue(spark, at)
    assert queue.queue().collect() == [] == queue.similar("anything").collect()
    run1 = proposals(spark, ("x1", "r1", "A1", "P1", "csm_escalation", "disputed invoice since spring"), ("x2", "r1", "A2", "P3", "dunning_email", "small late invoice"), ("x3", "r1", "A3", "P2", "dunning_email", "many late invoices"))
    assert queue.append(run1) == 3 and queue.append(run1) == 0
    assert [r["action_id"] for r in queue.preview().collect()] == ["x1", "x3", "x2"] and len(queue.preview(2).collect()) == 2
    queue.decide("x1", "edited", "kim", "Please call them first.")
    queue.decide("x2", "approved", "kim", "fine")
    again = ReviewQueue(spark, at)  # as after a restart
    again.decide("x3", "rejected", "lee", "paid meanwhile")
    with pytest.raises(ValueError, match="isn't pending"):
        again.decide("x3", "approved", "lee")
    with pytest.raises(ValueError, match="not a decision"):
        again.decide("x1", "maybe", "lee")
    assert {r["action_id"]: r["status"] for r in again.queue().collect()} == {"x1": "approved", "x2": "approved", "x3": "rejected"}
    assert {(r["action_id"], r["final_draft"], r["comment"]) for r in again.feedback().collect()} == {("x1", "Please call them first.", None), ("x2", "draft for A2", "fine"), ("x3", "draft for A3", "paid meanwhile")}
    # another run brings what is new only; states stay
    assert again.append(run1.unionByName(proposals(spark, ("y1", "r2", "A1", "P1", "csm_escalation", "disputed invoice again")))) == 1
    assert [r["action_id"] for r in again.preview().collect()] == ["y1"] and again.queue().where("status <> 'pending'").count() == 3
    assert [r["decision"] for r in again.recall("A1").collect()] == ["edited"]
    # examples: approved and edited drafts only, the most similar first
    assert [r["final_draft"] for r in again.similar("a disputed invoice").collect()] == ["Please call them first.", "draft for A2"]
    assert [r["final_draft"] for r in again.similar("many", 3).collect()] == []
    assert {(r["action_type"], r["priority"]): (r["decisions"], r["approved_share"], r["edited_share"], r["rejected_share"]) for r in again.reflection().collect()} == {("csm_escalation", "P1"): (1, 0.0, 1.0, 0.0), ("dunning_email", "P3"): (1, 1.0, 0.0, 0.0), ("dunning_email", "P2"): (1, 0.0, 0.0, 1.0)}


def test_bands(spark):
    rows = spark.createDataFrame([(-1.0,), (9.99,), (10.0,), (99.5,), (100.0,), (None,)], "x double")
    assert [r["b"] for r in rows.select(band("x", 10.0, 100.0).alias("b")).collect()] == ["under 10", "under 10", "10 to 100", "10 to 100", "100 and more", None]
    assert [r["b"] for r in rows.select(band(F.col("x") * 1000, 1000.0).alias("b")).collect()][:2] == ["under 1,000", "1,000 and more"]
