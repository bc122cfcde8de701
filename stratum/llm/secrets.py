"""Secret scans with an incremental blob ledger.

Every version of a text is content-addressed (SHA-256 of its UTF-8 bytes). The
ledger is a Parquet table of (blob, rule_version, spans) under a shared folder;
a scan with a rule set takes only blobs that the ledger has not yet seen with that
set's version, appends one ledger row per blob, also where nothing was found, and
findings are joined back to all paths that hold the blob. A new version scans
every blob anew and leaves the rows of the old one.

Scale: copies of one text are cut to one row per task before they are exchanged
by blob, so a text that a third of all rows repeat costs one row per task. Scanning is a
small per-row helper in Arrow batches. Findings join back on the
blob; blobs without findings are left out of that join, and AQE splits a hot
blob.

Recovery: the ledger is appended by one Spark write; a scan that dies before
its commit leaves no row, and the next one scans those blobs again. Readers
take distinct rows, so a blob scanned by two racing runs counts once.

Defined cases: null text is the empty blob. Repeated rows and rows with null
ids are paths of their blob like any other; each row is returned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from stratum.plans import storage

LEDGER = "blob binary, rule_version string, spans string"


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    flags: int = 0


@dataclass(frozen=True)
class RuleSet:
    version: str
    rules: tuple[Rule, ...]

    def find(self, text: str) -> list[tuple[int, int, int]]:
        """(start, rule number, end) of all findings, by start, then rule."""
        found = []
        for k, rule in enumerate(self.rules):
            for m in re.compile(rule.pattern, rule.flags).finditer(text):
                if m.end(rule.group) - m.start(rule.group) >= rule.least:
                    found.append((m.start(), k, m.end()))
        return sorted(found)

    def spans(self, text: str) -> str:
        return ",".join(f"{self.rules[k].kind}:{s}:{e}" for s, k, e in self.find(text))


# Fixed patterns of the contract.
BASE = RuleSet("base-1", (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6,
         re.IGNORECASE | re.ASCII),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24)))


def _scanner(rules: RuleSet):
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"blob": pdf["blob"], "rule_version": rules.version,
                                "spans": [rules.spans(t or "") for t in pdf["text"]]})
    return scan


def _address(text_col: str):
    return F.unhex(F.sha2(F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8"), 256))


def read_ledger(spark, path: str, rules: RuleSet = BASE) -> DataFrame:
    """The rows of a rule set's version; none if there is no ledger yet."""
    if not storage.exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path).where(F.col("rule_version") == rules.version).distinct()


def scan_increment(docs: DataFrame, ledger: str, rules: RuleSet = BASE, text_col: str = "text") -> None:
    """Scans the blobs of ``docs`` that the ledger at ``ledger`` lacks for the version of ``rules``, and appends them."""
    seen = read_ledger(docs.sparkSession, ledger, rules).select(F.col("blob").alias("_seen"))
    blobs = (docs.select(_address(text_col).alias("blob"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
                 .dropDuplicates(["blob"]))
    fresh = blobs.join(seen, F.col("blob") == F.col("_seen"), "left_anti")
    fresh.mapInPandas(_scanner(rules), LEDGER).write.mode("append").parquet(ledger)


def findings(docs: DataFrame, ledger: str, rules: RuleSet = BASE, text_col: str = "text") -> DataFrame:
    """``docs`` with its columns, plus ``_spans`` and ``_n_<kind>`` for every kind of ``rules``, from the ledger."""
    found = read_ledger(docs.sparkSession, ledger, rules).where("spans <> ''").select(
        F.xxhash64("blob").alias("_j"), F.col("blob").alias("_b"), F.col("spans").alias("_spans"))
    rows = docs.withColumn("_blob", _address(text_col)).withColumn("_j0", F.xxhash64("_blob"))
    out = rows.join(found, (F.col("_j0") == F.col("_j")) & (F.col("_blob") == F.col("_b")), "left")
    out = out.withColumn("_spans", F.coalesce("_spans", F.lit(""))).drop("_j", "_j0", "_b", "_blob")

    def count(kind):
        return F.size(F.filter(F.split("_spans", ","), lambda s: F.startswith(s, F.lit(f"{kind}:")))).cast("long")

    return out.withColumns({f"_n_{r.kind}": count(r.kind) for r in rules.rules})
