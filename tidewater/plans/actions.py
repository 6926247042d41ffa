"""Collections proposals: rules that find accounts to act on, a proposal record for each, and the review queue.

The text of a proposal is drafted by a callable that is passed in; a template
stands in for it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import number_or
from ..operators.feed import Consumer, VersionedTable
from ..operators.index import ChunkIndex
from ..operators.relational import update_where
from ..staging import written

#: Rules of the monitor: tiers, days overdue and receivables from which it acts.
TIERS, LEAST_DAYS, LEAST_AR = ("High", "Medium"), 30, 5000
ESCALATE_AR, LONG_DAYS = 100_000, 60


def is_actionable() -> Column:
    return F.col("risk_tier").isin(*TIERS) & (number_or("oldest_invoice_days") >= LEAST_DAYS) & (number_or("ar_balance") >= LEAST_AR)


def priority() -> Column:
    high = F.coalesce(F.col("risk_tier") == "High", F.lit(False))
    grave = (number_or("ar_balance") >= ESCALATE_AR) | F.coalesce(F.col("account_health") == "Critical", F.lit(False))
    return F.when(high & grave, "P1").when(high | (number_or("oldest_invoice_days") >= LONG_DAYS), "P2").otherwise("P3")


def signal() -> Column:
    return F.concat(F.col("risk_tier"), F.lit(" risk · "), number_or("oldest_invoice_days").cast("long").cast("string"), F.lit("d overdue · $"), F.format_number(number_or("ar_balance"), 0), F.lit(" AR · "), number_or("open_invoice_count").cast("long").cast("string"), F.lit(" open invoice(s)"))


def action_id(account: str, run: str) -> Column:
    return F.left(F.sha2(F.concat_ws("::", F.col(account), F.lit(run)), 256), F.lit(24))


def detect(accounts: DataFrame) -> DataFrame:
    """Accounts to act on, the most urgent first."""
    out = accounts.where(is_actionable()).withColumn("priority", priority()).withColumn("signal", signal())
    out = out.withColumn("action_type", F.when(F.col("priority") == "P1", "csm_escalation").otherwise("dunning_email"))
    return out.orderBy("priority", number_or("ar_balance").desc(), "account_id")


def facts(columns: list[str]) -> Column:
    """What is known of an account, a line each; nulls are left out."""
    return F.concat_ws("\n", *[F.when(F.col(c).isNotNull(), F.concat(F.lit(f"- {c}: "), F.col(c).cast("string"))) for c in columns])


def parse_draft(answer: Column | str) -> Column:
    """Struct (subject, body) of the first JSON object in a model's answer; the answer itself is the body of anything else."""
    a = F.col(answer) if isinstance(answer, str) else answer
    found = F.from_json(F.regexp_extract(a, r"(?s)\{.*\}", 0), "subject string, body string")
    return F.struct(F.coalesce(found["subject"], F.lit("Account follow-up")).alias("subject"), F.coalesce(found["body"], a).alias("body"))


def template_draft() -> Column:
    return F.concat(F.lit("Regarding "), F.col("account_name"), F.lit(": "), F.col("signal"))


def propose(accounts: DataFrame, run: str, draft: Callable[[], Column] = template_draft) -> DataFrame:
    """Proposal records of a run, all pending."""
    found = detect(accounts)
    return found.select(
        action_id("account_id", run).alias("action_id"), F.lit(run).alias("run_id"), F.lit("collections").alias("agent"), "account_id", "account_name", "priority", "action_type", "signal",
        facts(["risk_tier", "ar_balance", "oldest_invoice_days"]).alias("diagnosis"), draft().alias("draft"), F.lit("pending").alias("status"),
    )


def pending(queue: DataFrame) -> DataFrame:
    return queue.where("status = 'pending'").orderBy("priority", "account_id")


def decide(queue: DataFrame, feedback: DataFrame, action: str, decision: str, reviewer: str, note: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The queue and the feedback after one decision; edits keep the reviewer's text as the final draft."""
    row = queue.where(F.col("action_id") == action).select("action_id", F.lit(decision).alias("decision"), F.lit(reviewer).alias("reviewer"), F.when(F.lit(decision) == "edited", F.lit(note)).otherwise(F.col("draft")).alias("final_draft"))
    status = F.when(F.lit(decision) == "rejected", "rejected").otherwise("approved")
    return update_where(queue, F.col("action_id") == action, status=status), feedback.unionByName(row, allowMissingColumns=True)


def decisions(feedback: DataFrame) -> DataFrame:
    return feedback.groupBy("decision").count()


def recall(feedback: DataFrame, queue: DataFrame, account: str) -> DataFrame:
    """Past decisions on an account."""
    return feedback.join(queue.select("action_id", "account_id", "priority", "signal"), "action_id").where(F.col("account_id") == account)


class ReviewQueue:
    """Proposals and decisions kept in two tables below a folder, with an index of what was approved.

    A run's proposals are appended once; those that are there already keep their
    state.  A decision sets a proposal's status and notes the final draft; approved
    drafts are indexed with the signal they answered, as examples for new ones.
    """

    QUEUE = "action_id string, run_id string, agent string, account_id string, account_name string, priority string, action_type string, signal string, diagnosis string, draft string, status string, created_at timestamp"
    FEEDBACK = "action_id string, decision string, reviewer string, final_draft string, comment string, decided_at timestamp"

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self._queue, self._feedback = VersionedTable(spark, f"{path}/queue", ["action_id"]), VersionedTable(spark, f"{path}/feedback", ["action_id", "decided_at"])
        self._examples = VersionedTable(spark, f"{path}/examples", ["action_id"])
        self._index = ChunkIndex(spark, f"{path}/index", "action_id", "situation", "embedding", None)
        self._seen = Consumer(spark, f"{path}/_seen", self._examples)

    def _table(self, table: VersionedTable, schema: str) -> DataFrame:
        return table.read() if table.version else self.spark.createDataFrame([], schema)

    def queue(self) -> DataFrame:
        return self._table(self._queue, self.QUEUE)

    def feedback(self) -> DataFrame:
        return self._table(self._feedback, self.FEEDBACK)

    def append(self, proposals: DataFrame) -> int:
        """Take up proposals (as of :func:`propose`) that aren't known yet; returns how many came in."""
        known = self.queue()
        new = written(proposals.join(known.select("action_id"), "action_id", "left_anti").dropDuplicates(["action_id"]).withColumn("created_at", F.current_timestamp()).select(*known.columns))
        count = new.count()
        if count:
            self._queue.write(known.unionByName(new))
        return count

    def preview(self, most: int = 20) -> DataFrame:
        """The most urgent of what is pending, with the beginning of its diagnosis."""
        return pending(self.queue()).select("action_id", "priority", "account_name", "signal", F.left("diagnosis", F.lit(80)).alias("diagnosis")).limit(most)

    def decide(self, action: str, decision: str, reviewer: str, note: str | None = None) -> None:
        """Approve, reject or edit a proposal that is pending; ``note`` is the edited draft, else a comment."""
        if decision not in ("approved", "rejected", "edited"):
            raise ValueError(f"not a decision: {decision}")
        row = self.queue().where((F.col("action_id") == action) & (F.col("status") == "pending")).first()
        if row is None:
            raise ValueError(f"{action} isn't pending")
        queue, told = decide(self.queue(), self.feedback().limit(0).select("action_id", "decision", "reviewer", "final_draft"), action, decision, reviewer, note)
        told = told.withColumns({"comment": F.lit(None if decision == "edited" else note).cast("string"), "decided_at": F.current_timestamp()})
        self._feedback.write(self.feedback().unionByName(told))
        self._queue.write(queue)
        if decision != "rejected":
            example = told.join(queue.select("action_id", F.concat_ws(" ", "action_type", "priority", "signal", "diagnosis").alias("situation")), "action_id").select("action_id", "situation", "final_draft", F.lit(None).cast("array<double>").alias("embedding"))
            self._examples.write(self._examples.read().unionByName(example) if self._examples.version else example)
            self._seen.poll(self._index.sync)

    def recall(self, account: str) -> DataFrame:
        return recall(self.feedback(), self.queue(), account)

    def similar(self, situation: str, k: int = 3) -> DataFrame:
        """The approved drafts whose situation is most like this one (by keywords), best first: examples for a new draft."""
        if not self._examples.version:
            return self.spark.createDataFrame([], "rank int, situation string, final_draft string")
        hits = self._index.keyword(situation, k)
        return hits.join(self._examples.read(), "action_id").select("rank", "situation", "final_draft").orderBy("rank")

    def reflection(self) -> DataFrame:
        """How each kind of proposal fared: its decisions, the share approved as it was, and the share edited."""
        rows = self.feedback().join(self.queue().select("action_id", "action_type", "priority"), "action_id").groupBy("action_type", "priority")
        share = lambda d: F.round(F.avg((F.col("decision") == d).cast("double")), 4)
        return rows.agg(F.count(F.lit(1)).alias("decisions"), share("approved").alias("approved_share"), share("edited").alias("edited_share"), share("rejected").alias("rejected_share"))
