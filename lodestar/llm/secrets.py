"""Secrets by an incremental ledger of blobs.

A blob is a text addressed by its SHA-256. The ledger holds a row for each
pair of blob and rule version that has been scanned, with the spans found. A
run looks only at pairs the ledger does not have: one copy of each such blob
is scanned with the rules it still lacks, the pairs are appended, and findings
are joined back to every row (path and version) that holds the blob.

Null text counts as the empty blob, which has no findings. Equal rows share a
blob and each gets its findings. An empty table gives an empty result;
columns other than the id and the text are not looked at. A run that dies
leaves no partial batch behind: Spark commits a batch as a whole, and a batch
that was written twice changes no result, as pairs are grouped by blob.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lodestar.llm.common import column
from lodestar.llm.spans import located, matches, written
from lodestar.scratch import materialise, new_folder


@dataclass(frozen=True)
class Rule:
    """A pattern and its check; a change of either needs a new version."""

    name: str
    version: int
    pattern: str
    valid: Callable[[Column], Column]
    needs: str | None = None
    base: bool = True

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


def _always(match: Column) -> Column:
    return F.lit(True)


_ASSIGN = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*+[:=]\x20*+[\"']?([A-Za-z0-9+/_.=-]++)"
)

RULES = [
    Rule(
        "assign",
        1,
        _ASSIGN,
        lambda m: F.char_length(F.regexp_extract(m, _ASSIGN, 1)) >= 8,
    ),
    # AKIA[A-Z0-9]+ of 16 characters or more: a shorter run holds no longer one
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}+", _always, needs="AKIA"),
    # [0-9a-f]+ of 32 characters or more
    Rule("hex", 1, r"(?<![0-9a-f])[0-9a-f]{32,}+", _always),
    Rule("github", 1, r"(?<![A-Za-z0-9])gh[pousr]_[A-Za-z0-9]{36,}+", _always, "gh", False),
    Rule(
        "jwt",
        1,
        r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+",
        _always,
        "eyJ",
        False,
    ),
    Rule("private_key", 1, r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", _always, "PRIVATE KEY", False),
]

#: Columns of the ledger.
LEDGER = "blob binary, rule string, spans array<struct<start:int,end:int>>"


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All scanned pairs; none if the ledger does not exist yet."""
    try:
        return spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException:
        return spark.createDataFrame([], LEDGER)


def update_ledger(blobs: DataFrame, ledger: str, rules: list[Rule]) -> None:
    """Scan the pairs of ``blobs`` (``_id``, ``_blob``, ``_text``) that the ledger lacks."""
    spark = blobs.sparkSession
    wanted = F.array(*(F.lit(r.key) for r in rules))
    copies = materialise(
        blobs.groupBy("_blob").agg(F.min("_id").alias("_id"), F.count("*").alias("_copies")), "blobs"
    )
    seen = read_ledger(spark, ledger).groupBy("blob").agg(F.collect_set("rule").alias("_seen"))
    known = copies.join(seen, copies["_blob"] == seen["blob"], "left").drop("blob")
    lacking = F.array_except(wanted, F.coalesce("_seen", F.array().cast("array<string>")))
    # One copy of each blob: its text is shuffled to the pair, never sorted.
    todo = materialise(
        known.select(
            F.col("_blob").alias("_todo_blob"), F.col("_id").alias("_todo_id"), lacking.alias("_rules")
        ).where(F.size("_rules") > 0),
        "unseen-pairs",
    )
    match = (F.col("_blob") == F.col("_todo_blob")) & F.col("_id").eqNullSafe(F.col("_todo_id"))
    unseen = blobs.join(todo.hint("shuffle_hash"), match)
    text = F.col("_text")

    def due(rule: Rule) -> Column:
        needed = F.array_contains("_rules", rule.key)
        return needed & F.contains(text, F.lit(rule.needs)) if rule.needs else needed

    proposed = unseen.select(
        "_blob",
        "_text",
        "_rules",
        *(matches(text, r.pattern, due(r)).alias(f"_found{i}") for i, r in enumerate(rules)),
    )
    pairs = F.array(
        *(
            F.struct(
                F.lit(r.key).alias("rule"),
                F.transform(
                    located(text, F.col(f"_found{i}"), r.pattern, r.valid),
                    lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")),
                ).alias("spans"),
            )
            for i, r in enumerate(rules)
        )
    )
    scanned = proposed.select(
        "_blob", F.explode(F.filter(pairs, lambda p: F.array_contains("_rules", p["rule"]))).alias("pair")
    )
    scanned.select(F.col("_blob").alias("blob"), "pair.rule", "pair.spans").write.mode(
        "append"
    ).parquet(ledger)


def scan_history(
    docs: DataFrame,
    ledger: str | None = None,
    rules: list[Rule] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document with ``spans``: rule, start and end, ordered by start, then rule.

    ``ledger`` is a folder that all executors share and that later runs pass
    again; without one this run has a ledger of its own.
    """
    spark = docs.sparkSession
    rules = RULES if rules is None else rules
    ledger = ledger or new_folder(spark, "secret-ledger")
    blobs = docs.select(
        column(docs, id_column).alias("_id"),
        F.coalesce(column(docs, text_column), F.lit("")).alias("_text"),
    ).select("_id", F.unhex(F.sha2("_text", 256)).alias("_blob"), "_text")
    update_ledger(blobs, ledger, rules)
    keys = [r.key for r in rules]
    found = (
        read_ledger(spark, ledger)
        .where(F.col("rule").isin(keys) & (F.size("spans") > 0))
        .groupBy("blob")
        .agg(F.collect_set(F.struct("rule", "spans")).alias("pairs"))
    )
    order = F.create_map(*(F.lit(x) for i, r in enumerate(rules) for x in (r.key, i)))
    flat = F.flatten(
        F.transform(
            "pairs",
            lambda p: F.transform(
                p["spans"],
                lambda s: F.struct(
                    s["start"].alias("start"),
                    order[p["rule"]].alias("place"),
                    s["end"].alias("end"),
                ),
            ),
        )
    )
    names = F.array(*(F.lit(r.name) for r in rules))
    base = F.array(*(F.lit(r.base) for r in rules))
    spans = F.transform(
        F.array_sort(flat),
        lambda s: F.struct(
            names[s["place"]].alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            base[s["place"]].alias("base"),
        ),
    )
    # Stored, so that the join may split the rows of a blob that many paths hold.
    findings = materialise(found.select("blob", spans.alias("spans")), "findings")
    paths = blobs.select("_id", "_blob")
    joined = paths.join(findings, paths["_blob"] == findings["blob"], "left")
    none = F.array().cast("array<struct<kind:string,start:int,end:int,base:boolean>>")
    return joined.select(
        F.col("_id").alias(id_column),
        F.lower(F.hex("_blob")).alias("blob"),
        F.coalesce("spans", none).alias("spans"),
    )


def secret_report(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """Counts and a digest of the base spans, and all spans as text, per document."""
    found = scan_history(docs, ledger)

    def count(name: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long")

    return found.select(
        "doc_id",
        *(count(r.name).alias(f"n_{r.name}") for r in RULES if r.base),
        F.sha2(written(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
        "blob",
    )
