"""Secret scans over an incremental blob ledger (operator 2).

Every version of every text is a blob named by the SHA-256 of its bytes. The
ledger is a Parquet table of scanned ``(blob, rule_version)`` pairs with their
findings; it only grows. A scan

1. reduces the given rows to distinct blobs, keeping one path of each
   (map-side, so a hot blob is one row per task);
2. drops the pairs the ledger already has (anti-join) and scans the rest, each
   once, whole, wherever its text lies;
3. appends the findings to the ledger, and joins findings back to every path.

A run that dies before the append is committed adds nothing and is repeated; a
pair that two runs both scanned reads as one.

Defined results: a null text is the empty blob; repeated rows get the same
findings; a null id is a path like any other; an empty table scans nothing;
columns that are not named are not read.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm.store import fresh_name

# Base kinds in the contract's order, then the kinds this operator adds.
BASE_KINDS = ("assign", "access", "hex")
EXTRA_KINDS = ("pem", "jwt", "github", "slack", "google")
KINDS = BASE_KINDS + EXTRA_KINDS
# Name of the rule set; a change of any rule needs a new name, which rescans all blobs.
RULE_VERSION = "rules-3"

LEDGER_SCHEMA = ("blob string, rule_version string, n_assign bigint, n_access bigint, n_hex bigint, "
                 "base_sha256 string, spans string")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.ASCII | re.IGNORECASE)
_ASSIGN_WORDS = ("passw", "secret", "token", "api")
# A private key from its BEGIN line to the END line of its kind (none in between begins another key); without
# one, to the end of the key lines that follow: base64 alone on a line, long base64 runs, cipher headers. Line
# breaks may be written as \n.
_PEM = (r"-----BEGIN ([A-Z ]{0,40})PRIVATE KEY-----(?:(?:(?!-----BEGIN )[\s\S])*?-----END \1PRIVATE KEY-----"
        r"|(?:(?:\s|\\[rn])*+(?:[A-Za-z0-9+/]{40,}+={0,2}|(?:Proc-Type|DEK-Info):[^\n\\]*+)"
        r"|(?:\\[rn])++[A-Za-z0-9+/]++={0,2}"
        r"|[ \t\r]*+\n\s*+[A-Za-z0-9+/]++={0,2}[ \t\r]*+(?=\n|\Z))*+)")
# A run of hex digits, or AKIA and its run, always ends where the run ends, so
# asking for the least length in the pattern finds the same spans as dropping short ones.
_PATTERNS = {
    "access": re.compile(r"AKIA[A-Z0-9]{12,}"),
    "hex": re.compile(r"[0-9a-f]{32,}"),
    "pem": re.compile(_PEM),
    "jwt": re.compile(r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    "github": re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}"),
    "slack": re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    "google": re.compile(r"AIza[A-Za-z0-9_-]{35}"),
}
# Fixed text every match of a kind holds; a text without it is not searched for that kind.
_NEEDLES = {"access": "AKIA", "pem": "PRIVATE KEY-----", "jwt": "eyJ", "github": "gh", "slack": "xox", "google": "AIza"}


def find(text: str) -> list[tuple[str, int, int]]:
    """All findings of one text as ``(kind, start, end)`` by start, then kind."""
    out = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    for kind, pattern in _PATTERNS.items():
        if kind not in _NEEDLES or _NEEDLES[kind] in text:
            out += [(kind, *m.span()) for m in pattern.finditer(text)]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str, spans: str, mark: str = "[SECRET]") -> str:
    """The text with every span of ``kind:start:end,...``, overlapping ones united, replaced by ``mark``."""
    out, at = [], 0
    for span in filter(None, spans.split(",")):
        a, b = map(int, span.split(":")[1:])
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def _blob(text_col: str) -> F.Column:
    return F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger so far: one row per ``(blob, rule_version)``; empty if nothing was written yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def _scan(batches):
    for pdf in batches:
        rows = []
        for blob, version, text in zip(pdf["blob"], pdf["rule_version"], pdf["text"]):
            spans = find(text)
            base = [s for s in spans if s[0] in BASE_KINDS]
            n = {k: sum(s[0] == k for s in base) for k in BASE_KINDS}
            rows.append((blob, version, n["assign"], n["access"], n["hex"],
                         hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in LEDGER_SCHEMA.split(", ")])


def scan_new(docs: DataFrame, ledger_path: str, id_col: str = "doc_id", text_col: str = "text",
             rule_version: str = RULE_VERSION) -> None:
    """Scan every blob of ``docs`` the ledger has not seen under this rule version, and append the findings."""
    spark = docs.sparkSession
    seen = read_ledger(spark, ledger_path).where(F.col("rule_version") == rule_version).select("blob")
    rows = docs.select(F.col(id_col).alias("path"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       _blob(text_col).alias("blob"))
    # one path of each unseen blob; the text is fetched by blob and path together, so copies do not meet in one task
    todo = rows.groupBy("blob").agg(F.min("path").alias("at")).join(seen, "blob", "left_anti")
    todo = todo.select(F.col("blob").alias("b"), "at").hint("shuffle_hash")
    fresh = rows.join(todo, (F.col("blob") == F.col("b")) & F.col("path").eqNullSafe(F.col("at")))
    (fresh.select("blob", F.lit(rule_version).alias("rule_version"), "text")
          .mapInPandas(_scan, LEDGER_SCHEMA)
          .write.mode("append").parquet(ledger_path))


def findings(docs: DataFrame, ledger_path: str, id_col: str = "doc_id", text_col: str = "text",
             rule_version: str = RULE_VERSION) -> DataFrame:
    """Findings of every path: the id with the ledger row of its blob."""
    ledger = (read_ledger(docs.sparkSession, ledger_path).where(F.col("rule_version") == rule_version)
              .drop("rule_version").dropDuplicates(["blob"]))
    paths = docs.select(F.col(id_col).alias("doc_id"), _blob(text_col).alias("blob"))
    return paths.join(ledger, "blob").select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "blob")


def secrets(docs: DataFrame, ledger_path: str, id_col: str = "doc_id", text_col: str = "text",
            rule_version: str = RULE_VERSION) -> DataFrame:
    """Scan what is new, then the findings of every row of ``docs``."""
    scan_new(docs, ledger_path, id_col, text_col, rule_version)
    return findings(docs, ledger_path, id_col, text_col, rule_version)


def redacted(docs: DataFrame, ledger_path: str, id_col: str = "doc_id", text_col: str = "text",
             rule_version: str = RULE_VERSION) -> DataFrame:
    """All rows of ``docs`` with their columns, secrets of the text replaced by a mark; scans what is new first."""
    scan_new(docs, ledger_path, id_col, text_col, rule_version)
    key, found = fresh_name("blob", docs), fresh_name("spans", docs)
    dirty = (read_ledger(docs.sparkSession, ledger_path).where((F.col("rule_version") == rule_version) & (F.col("spans") != ""))
             .dropDuplicates(["blob"]).select(F.col("blob").alias(key), F.col("spans").alias(found)))
    rows = docs.join(dirty, _blob(text_col) == F.col(key), "left").drop(key)

    def task(batches):
        for batch in batches:
            i, spans = batch.schema.get_field_index(text_col), batch.column(batch.num_columns - 1).to_pylist()
            texts = [t if s is None or t is None else redact(t, s) for t, s in zip(batch.column(i).to_pylist(), spans)]
            cols = batch.columns[:-1]
            cols[i] = pa.array(texts, batch.schema.field(i).type)
            yield pa.RecordBatch.from_arrays(cols, batch.schema.names[:-1])
    return rows.mapInArrow(task, docs.schema)
