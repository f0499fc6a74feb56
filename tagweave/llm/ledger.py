"""Secret scans with a ledger of blobs.

Every version of every path is addressed by the SHA-256 of its content. The
ledger knows which pairs of blob and rule version have been scanned, and what was
found in them. A run scans each unseen blob once, however many paths and versions
hold it, appends to the ledger, and joins all findings back to the paths.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.llm.common import digest_spans, documents, map_batches, slim, to_batch
from tagweave.sources.tables import materialize, shared_folder

RULES_VERSION = 1

_BASE = {
    "assign": re.compile(
        r"(?ai)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    ),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]{24,}"),
}
# The ledger's own rules: token formats with a mark of their own, each gated by a fixed string.
_MORE = {
    "private_key": ("-----BEGIN", re.compile(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----")),
    "jwt": ("eyJ", re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
    "host_token": ("gh", re.compile(r"(?<![A-Za-z0-9])gh[pousr]_[A-Za-z0-9]{36,}")),
    "chat_token": ("xox", re.compile(r"(?<![A-Za-z0-9])xox[abprs]-[A-Za-z0-9-]{10,}")),
    "map_key": ("AIza", re.compile(r"(?<![A-Za-z0-9_-])AIza[A-Za-z0-9_-]{35}")),
    "url_login": ("://", re.compile(r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,100}:[^\s/:@]{3,200}@")),
}
KINDS = (*_BASE, *_MORE)
Span = tuple[int, int, int]  # start, kind, end


def detect(text: str) -> tuple[list[Span], list[Span]]:
    """The base spans and the further ones, each by start, then kind."""
    base, more = [], []
    for m in _BASE["assign"].finditer(text):
        if len(m[1]) >= 6:
            base.append((m.start(), 0, m.end()))
    if "AKIA" in text:
        base += [(m.start(), 1, m.end()) for m in _BASE["access"].finditer(text) if m.end() - m.start() >= 20]
    base += [(m.start(), 2, m.end()) for m in _BASE["hex"].finditer(text)]
    for kind, (sign, pattern) in enumerate(_MORE.values(), len(_BASE)):
        if sign in text:
            more += [(m.start(), kind, m.end()) for m in pattern.finditer(text)]
    return sorted(base), sorted(more)


def say(spans: Iterable[Span]) -> list[str]:
    return [f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans)]


FINDINGS = "blob binary, rules int, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
NOTHING = (0, 0, 0, digest_spans([]), "")


def _blobs(batch: pa.RecordBatch) -> dict:
    digests = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest() for t in batch.column("text").to_pylist()]
    return {"doc_id": batch.column("doc_id"), "blob": digests}


def _once_a_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each blob's content once, before it is moved: the copies in a task are put together."""
    seen: set[bytes] = set()
    for batch in batches:
        keep = []
        for text in batch.column("text").to_pylist():
            blob = hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()
            keep.append(None if blob in seen else blob)
            seen.add(blob)
        column = pa.array(keep, pa.binary())
        yield pa.RecordBatch.from_arrays([column, batch.column("text")], names=["blob", "text"]).filter(column.is_valid())


def _scan(batches: Iterator[pa.RecordBatch], rules: int) -> Iterator[pa.RecordBatch]:
    """Findings of the blobs of a partition, sorted by blob, each blob once; one that begins without a text is known."""
    last = None
    for batch in batches:
        out: dict[str, list] = {field.split()[0]: [] for field in FINDINGS.split(",")}
        for blob, text in zip(batch.column("blob").to_pylist(), batch.column("text"), strict=True):
            if blob != last and text.is_valid:
                base, more = detect(text.as_py())
                counts = [sum(kind == k for _, kind, _ in base) for k in range(3)]
                row = (blob, rules, *counts, digest_spans(say(base)), ",".join(say(base + more)))
                for column, value in zip(out.values(), row, strict=True):
                    column.append(value)
            last = blob
        yield to_batch(out, FINDINGS)


class Ledger:
    """Findings of every scanned pair of blob and rule version, in runs below one folder.

    The folder is the ledger: whoever opens it later has the findings of all
    earlier runs. A run's findings become part of it when its folder is complete,
    so a run that was lost half-way is scanned again. A blob without findings has
    a row too: that row says it was scanned.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self._own: set[str] = set()

    def runs(self) -> list[str]:
        """The complete runs below the folder, whoever wrote them."""
        context = self.spark.sparkContext
        new = context._jvm.org.apache.hadoop.fs.Path
        folder = new(self.path)
        files = folder.getFileSystem(context._jsc.hadoopConfiguration())
        names = [x.getPath().getName() for x in files.listStatus(folder)] if files.exists(folder) else []
        paths = {f"{self.path}/{name}" for name in names if name.startswith("run-")}
        return sorted(self._own | {path for path in paths if files.exists(new(f"{path}/_SUCCESS"))})

    def findings(self) -> DataFrame:
        """What all complete runs found, each (blob, rules) pair once; no rows of an empty ledger."""
        runs = self.runs()
        if not runs:
            return self.spark.createDataFrame([], FINDINGS)
        return self.spark.read.schema(FINDINGS).parquet(*runs)

    def append(self, rows: DataFrame) -> None:
        run = f"{self.path}/run-{uuid.uuid4().hex}"
        rows.write.mode("error").parquet(run)
        self._own.add(run)

    def scan(self, versions: DataFrame, rules: int = RULES_VERSION, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Scan what is new in ``versions`` and return the findings of all its rows.

        One row per input row. A null content counts as empty; repeated rows,
        equal contents and null ids give rows of their own with equal findings.
        """
        rows = slim(versions, id_col, text_col)
        paths = materialize(map_batches(rows, _blobs, "doc_id long, blob binary"), "blob-paths")
        contents = rows.select("text").mapInArrow(_once_a_task, "blob binary, text string")
        # What is known meets the contents in the one shuffle that puts copies together.
        scanned = self.findings().where(F.col("rules") == rules).select("blob", F.lit(None).cast("string").alias("text"))
        by_blob = contents.unionByName(scanned).repartition("blob").sortWithinPartitions("blob", F.col("text").isNotNull())
        self.append(by_blob.mapInArrow(lambda batches: _scan(batches, rules), FINDINGS))
        found = self.findings().where((F.col("rules") == rules) & (F.col("spans") != "")).drop("rules")
        found = found.dropDuplicates(["blob"])  # runs at the same time may have scanned the same blob
        names = ("n_assign", "n_access", "n_hex", "base_sha256", "spans")
        return paths.join(materialize(found.withColumnRenamed("blob", "of"), "blob-findings"), F.col("blob") == F.col("of"), "left").select(
            "doc_id", F.hex("blob").alias("blob"), *[F.coalesce(n, F.lit(v)).alias(n) for n, v in zip(names, NOTHING, strict=True)]
        )


def op10_blob_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Two arrivals of documents at one ledger, which is opened anew for the second."""
    docs, path = documents(spark, folder), f"{shared_folder(spark)}/blob-ledger-{uuid.uuid4().hex}"
    late = F.xxhash64("doc_id") % 2 != 0
    first = Ledger(spark, path).scan(docs.where(~late))
    return first.unionByName(Ledger(spark, path).scan(docs.where(late)))
