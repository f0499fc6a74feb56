"""Small tables with every awkward case, and plain versions of what the operators compute."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
# Names that the operators use inside.
CLASHING = ("row size key digest n cls class component place part ids start of level text_sha256 sketch tag group _of a b").split()

WORDS = "amber basin copper delta ember fjord grove harbor inlet juniper kelp lagoon meadow nectar orchid prairie quarry".split()


def prose(seed: int, n: int) -> str:
    state, out = seed * 7919 + 13, []
    for i in range(n):
        state = (state * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(state >> 16) % len(WORDS)] + str((state >> 8) % 97))
        out.append("\n" if i % 12 == 11 else " ")
    return "".join(out).strip()


def awkward_rows() -> list[tuple[int | None, str | None, str | None]]:
    long = prose(3, 6_000)
    near = prose(4, 120).split(" ")
    return [
        (1, prose(1, 80), "src1"),
        (2, None, "src1"),
        (3, "", "src2"),
        (3, "", "src2"),
        (4, " \t\n\x0b\x0c\r ", "src2"),
        (None, prose(2, 90), "src3"),
        (None, prose(2, 90), None),
        (5, long, "src3"),
        (6, long + "\n", "src3"),
        (7, " ".join(near), "src1"),
        (8, " ".join([*near[:60], "changed", *near[61:]]), "src1"),
        (9, prose(5, 30) + "\n" + long[2_000:3_000], None),
        (10, "one two three", "src1"),
        (11, "ONE two  three", "src1"),
        (12, "é ñ 日本 ​!", "srcé"),
        (12, prose(6, 70), "srcé"),
        (13, prose(6, 70), "src0"),
    ]


def table(spark: SparkSession, rows: list) -> DataFrame:
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    return df.withColumns({name: F.lit(f"clash {name}") for name in CLASHING})


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def near_groups(rows: list[tuple]) -> list[tuple[int | None, int, int | None]]:
    """(doc_id, size of the shingle set, smallest id reached) by comparing all pairs that share a shingle."""
    sets = []
    for _, text, *_ in rows:
        w = words(lower(text))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    both = Counter((i, j) for at in where.values() for k, j in enumerate(at) for i in at[:k])
    root = list(range(len(rows)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for (i, j), n in both.items():
        if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
            root[find(j)] = find(i)
    least: dict[int, int | None] = {}
    for i, row in enumerate(rows):
        r = find(i)
        ids = [x for x in (row[0], least.get(r)) if x is not None]
        least[r] = min(ids, default=None)
    return [(row[0], len(sets[i]), least[find(i)]) for i, row in enumerate(rows)]


def without_repeats(rows: list[tuple], width: int = 400) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) by counting every string of ``width`` bytes."""
    seen = Counter()
    texts = [(text or "").encode() for _, text, *_ in rows]
    for b in texts:
        seen.update(b[i : i + width] for i in range(len(b) - width + 1))
    out = []
    for (doc_id, *_), b in zip(rows, texts, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if seen[b[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((doc_id, len(b), sum(gone), spans, sha(kept)))
    return out


def ordered(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=repr)


def stored(spark: SparkSession, folder: str = FOLDER) -> list[tuple]:
    return [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source").collect()]
