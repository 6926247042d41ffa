import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA
from tidewater import queries as q
from tidewater.operators import rules
from tidewater.operators.expectations import drop, warn
from tidewater.plans import dashboards, evals
from tidewater.plans.registry import DATASETS, Context, Dataset, materialize
from tidewater.plans.runlog import RunLog
from tidewater.staging import place
from tidewater.streaming import flows


def test_every_kind_of_rule_has_a_case_that_fails(spark):
    rows = [(1, "USD", 5.0, dt.date(2024, 1, 1), dt.date(2024, 1, 2), 5.0, "p1"), (1, "XXX", -1.0, dt.date(1990, 1, 1), dt.date(1989, 1, 1), 9.0, "p9"), (None, None, None, None, None, None, None), (2, "EUR", 11.0, dt.date(2025, 6, 1), dt.date(2025, 6, 1), 12.1, "p9")]
    child = spark.createDataFrame(rows, "id int, currency string, x double, a date, b date, y double, parent string")
    parent = spark.createDataFrame([("p1",), ("p1",), (None,)], "key string")
    own = [
        *rules.not_null("c", "id", "x"), rules.one_of("c", "parent", "p1", "p2"), rules.currency("c"), rules.within("c", "x", 0, 10), rules.within("c", "y", None, 9.0), rules.dated("c", "a", dt.date(2000, 1, 1), 30),
        rules.ordered("c", "a", "b"), rules.agrees("c", "x", "y", 1.0), rules.references("c", "parent", "p", "key"), rules.unique("c", "id"), rules.unique("p", "key"),
    ]
    checked = rules.check(own, {"c": child, "p": parent}.__getitem__, dt.date(2024, 12, 31))
    got = {(r["dataset"], r["rule"]): (r["rows"], r["failed"]) for r in checked.collect()}
    assert got == {
        ("c", "id_not_null"): (4, 1), ("c", "x_not_null"): (4, 1), ("c", "parent_one_of"): (4, 2), ("c", "currency_accepted"): (4, 1), ("c", "x_within"): (4, 2), ("c", "y_within"): (4, 1), ("c", "a_dated"): (4, 2),
        ("c", "a_before_b"): (4, 1), ("c", "x_agrees_with_y"): (4, 2), ("c", "parent_in_p"): (4, 2), ("c", "id_unique"): (4, 1), ("p", "key_unique"): (3, 1),
    }
    card = {r["dataset"]: tuple(r)[1:] for r in rules.scorecard(checked).collect()}
    assert card == {"c": (11, 11, 4, 16, round(100 * 28 / 44, 2)), "p": (1, 1, 3, 1, 66.67)}
    empty = rules.check(own, {"c": child.limit(0), "p": parent.limit(0)}.__getitem__, dt.date(2024, 12, 31))
    assert {(r["rows"], r["failed"]) for r in empty.collect()} == {(0, 0)} and {r["score"] for r in rules.scorecard(empty).collect()} == {100.0}
    with pytest.raises(ValueError, match="one name"):
        rules.check([own[0], own[0]], {"c": child}.__getitem__, dt.date.today())
    with pytest.raises(ValueError, match="kind"):
        rules.check([rules.Rule("c", "n", "odd", ("id",))], {"c": child}.__getitem__, dt.date.today())


def test_a_run_leaves_a_log_that_the_dashboards_read(spark):
    ctx = q.context(spark, DATA)
    log = RunLog(spark, place(spark), "conformed")
    assert log.events().collect() == [] == log.runs().collect()
    materialize(Context(spark, ctx.source, ctx.as_of), ["silver_invoice"], place(spark), log)

    def broken(c):
        return c.read("crm_territories").select(F.raise_error(F.lit("no such luck")).alias("territory_id"))

    DATASETS["broken"] = Dataset("broken", "silver", broken, (drop("has_id", "territory_id IS NOT NULL"), warn("odd", "length(territory_id) > 3")))
    try:
        with pytest.raises(Exception, match="no such luck"):
            materialize(Context(spark, ctx.source, ctx.as_of), ["broken"], place(spark), log)
    finally:
        del DATASETS["broken"]
    told = Context(spark, log.source(ctx.source), ctx.as_of)
    now = dt.datetime.now(dt.UTC).replace(tzinfo=None) + dt.timedelta(minutes=1)
    rates = {(r["dataset"], r["expectation_name"]): (r["passed"], r["failed"]) for r in dashboards.rule_pass_rates(told, now).collect()}
    rows = ctx.read("erp_invoices").count()
    assert rates["silver_invoice", "valid_currency"] == (rows, 0) and sum(rates["silver_invoice", "referential_customer"]) == rows
    assert {d for d, _ in rates} == {"silver_customer", "silver_payment", "silver_invoice"}
    assert [(r["level"], r["event_type"]) for r in dashboards.error_events(told, now).collect()] == [("ERROR", "update_progress")]
    assert sorted(r["result_state"] for r in dashboards.recent_runs(told, now).collect()) == ["FAILED", "SUCCEEDED"]
    assert [(r["runs"], r["succeeded"]) for r in dashboards.job_reliability(told, now).collect()] == [(2, 1)]
    assert told.read("crm_territories").count() > 0  # other relations are the source's


def test_streams_are_noted(spark, tmp_path):
    import time

    log = RunLog(spark, place(spark), "streams")
    listener = log.listener()
    spark.streams.addListener(listener)
    try:
        spark.range(7).write.parquet(str(tmp_path / "s"))
        flows.drain(spark.readStream.schema("id long").parquet(str(tmp_path / "s")), str(tmp_path / "mark"), str(tmp_path / "out"))
        for _ in range(50):
            if any(e[1] == "stream_ended" for e in log._events):
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    log.flush()
    got = [(r["event_type"], r["rows"]) for r in log.events().select("event_type", F.get_json_object("details", "$.stream_progress.num_input_rows").alias("rows")).collect()]
    assert ("stream_progress", "7") in got and {t for t, _ in got} == {"stream_started", "stream_progress", "stream_ended"}


def test_chunk_use_against_plain(spark):
    import random
    import re

    rng = random.Random(1)
    words = "red green blue Black white grün".split()
    answers = [(f"a{i}", " ".join(rng.choices(words, k=rng.choice([3, 5, 40, 200]))) + ".") for i in range(12)] + [("none", None)]
    retrieved = []
    for i, text in answers:
        own = (text or "").split(" ")
        retrieved += [(i, n, " ".join(["x y", *own[n : n + rng.choice([4, 5, 9])], "z", *rng.choices(words, k=12)])) for n in range(4)] + [(i, 9, None)]
    got = {tuple(r) for r in evals.chunk_use(spark.createDataFrame(answers, "answer_id string, answer string"), spark.createDataFrame(retrieved, "answer_id string, chunk_id int, chunk_text string")).collect()}
    texts, want = dict(answers), set()
    split = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    for a, c, chunk in retrieved:
        w, own = split(chunk), split(texts[a])
        runs = {tuple(own[k : k + 5]) for k in range(len(own) - 4)}
        hit = [tuple(w[k : k + 5]) in runs for k in range(max(len(w) - 4, 0))]
        covered = [any(hit[max(0, k - 4) : k + 1]) for k in range(len(w))]
        longest = max((len(m) + 4 for m in re.findall("1+", "".join("01"[h] for h in hit))), default=0)
        want.add((a, c, len(w), sum(covered), longest, any(hit)))
    assert got == want and any(r[5] for r in want)
    share = {r["answer_id"]: (r["chunks"], r["used_chunks"], r["utilisation"]) for r in evals.utilisation(spark.createDataFrame(list(got), "answer_id string, chunk_id int, words long, used_words long, longest_run long, used boolean")).collect()}
    assert share["none"] == (5, 0, 0.0) and all(u == round(k / n, 6) for n, k, u in share.values())


def test_row_rules_are_counted_with_a_key(spark, tmp_path):
    """A dataset with row rules and a reference is read once, and its null keys and dangling ones count as before."""
    for name, rows in (("d", [(1, 5.0), (1, None), (2, 3.0), (9, None), (None, 1.0)]), ("p", [(1, 0.0), (2, 0.0), (2, 0.0)])):
        spark.createDataFrame(rows, "k int, v double").write.parquet(f"{tmp_path}/{name}")
    wanted = [*rules.not_null("d", "v"), rules.within("d", "v", 2.0, None), rules.references("d", "k", "p", "k")]
    out = rules.check(wanted, lambda n: spark.read.parquet(f"{tmp_path}/{n}"), dt.date(2000, 1, 1))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
    assert sorted(tuple(r) for r in out.collect()) == [("d", "k_in_p", "references", 5, 1), ("d", "v_not_null", "not_null", 5, 2), ("d", "v_within", "within", 5, 1)]
    none = rules.check([*wanted, rules.unique("d", "k")], lambda n: spark.read.parquet(f"{tmp_path}/{n}").limit(0), dt.date(2000, 1, 1))
    assert {(r["rows"], r["failed"]) for r in none.collect()} == {(0, 0)} and none.count() == 4


def test_invoices_are_made_once_for_several_readers(spark):
    from tidewater import more_queries, quality_queries

    for build in (more_queries.actionable_accounts, quality_queries.dq_scorecard):
        ctx = q.context(spark, DATA)
        plan = build(ctx)._jdf.queryExecution().optimizedPlan().toString()
        # only the rules of payments themselves read line items in the query; invoices are read from where they were written
        assert plan.count("AS payment_amount") == (1 if build is quality_queries.dq_scorecard else 0), build


def test_steps_that_are_no_targets_need_not_be_written(spark):
    """Without steps, payments are summed within the invoices: the same invoices and counts, and no table of payments."""
    told = {}
    for steps in (True, False):
        ctx = q.context(spark, DATA)
        log = RunLog(spark, place(spark), "conformed")
        paths = materialize(Context(spark, ctx.source, ctx.as_of), ["silver_invoice"], place(spark), log, steps=steps)
        assert set(paths) == {"silver_customer", "silver_invoice"} | ({"silver_payment"} if steps else set())
        (counts,) = [r["details"].split('"data_quality"')[1] for r in log.events().where("message LIKE 'silver_invoice:%'").collect()]
        told[steps] = counts, sorted(map(str, spark.read.parquet(paths["silver_invoice"]).collect()))
    assert told[True] == told[False] and told[True][1]
