"""State of a resumable run as a log of numbered epochs (O-T02).

Each ``append`` writes the outcomes of some work as one epoch: a folder of rows and a small file with the rows' count and
digest, renamed into place when the rows are there.  Every ``every`` epochs the latest status of each id is written as a
snapshot with a digest of its own; two generations of snapshots stay, with the epochs since the older one.  A reader takes
the newest snapshot whose rows agree with its digest and all later epochs that do: an unreadable snapshot costs nothing, an
unreadable epoch its own rows.

    root/<config hash>/epochs/n=7/part-….parquet, root/<config hash>/epochs/00000007.json, the same under snapshots/
    root/<config hash>/tables/<name>/…            profiles, splits and other tables, as versions
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strokelab.operators import joins
from strokelab.sources import tables, versioned

ROWS = "id string, status string, updated_at long"


def facts() -> list[Column]:
    """Number of rows, and a digest that neither their order nor their files change."""
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.expr("bit_xor(xxhash64(id, status, updated_at))"), F.lit(0)).alias("digest")]


class StateLog:
    """The log of one configuration; another configuration's hash has a log of its own and starts afresh."""

    def __init__(self, spark: SparkSession, root: str, config_hash: str, every: int = 10):
        self.spark, self.home, self.every = spark, f"{root.rstrip('/')}/{config_hash}", every

    # Generations: numbered folders of rows with a digest file each.

    def _write(self, rows: DataFrame, kind: str, number: int) -> None:
        folder = f"{self.home}/{kind}/n={number}"
        # Left by a run that ended before its digest file was there.
        fs, p = tables._hadoop(self.spark, folder)
        if fs.exists(p):
            fs.delete(p, True)
        rows.select("id", "status", F.col("updated_at").cast("long").alias("updated_at")).write.parquet(folder)
        written = self.spark.read.schema(ROWS).parquet(folder).agg(*facts()).first()
        versioned.publish(self.spark, written.asDict(), versioned.numbered_file(f"{self.home}/{kind}", number))

    def _numbers(self, kind: str) -> list[int]:
        return versioned.numbers(self.spark, f"{self.home}/{kind}")

    def good(self, kind: str) -> list[int]:
        """Numbers whose rows agree with their digest, newest first; all are counted in one pass."""
        told = {n: versioned.published(self.spark, versioned.numbered_file(f"{self.home}/{kind}", n)) for n in self._numbers(kind)}
        fs, _ = tables._hadoop(self.spark, self.home)
        there = [n for n in told if told[n] and fs.exists(tables._hadoop(self.spark, f"{self.home}/{kind}/n={n}")[1])]
        if not there:
            return []
        seen = self._rows(kind, there, ignore=True).groupBy("n").agg(*facts()).collect()
        found = {r["n"]: {"rows": r["rows"], "digest": r["digest"]} for r in seen}
        return [n for n in there if found.get(n, {"rows": 0, "digest": 0}) == told[n]]

    def _rows(self, kind: str, which: list[int], ignore: bool = False) -> DataFrame:
        """Rows of some generations with their number; ``ignore`` skips files that can't be read."""
        reader = self.spark.read.schema(f"{ROWS}, n int").option("basePath", f"{self.home}/{kind}").option("ignoreCorruptFiles", str(ignore).lower()).option("ignoreMissingFiles", str(ignore).lower())
        return reader.parquet(*[f"{self.home}/{kind}/n={n}" for n in which])

    # The log.

    def append(self, outcomes: DataFrame) -> int:
        """Write outcomes (id, status, updated_at) as the next epoch; its number."""
        number = max([0, *self._numbers("epochs"), *self._numbers("snapshots")]) + 1
        self._write(outcomes, "epochs", number)
        if number % self.every == 0:
            self.compact(number)
        return number

    def compact(self, number: int) -> None:
        """Snapshot of all epochs up to ``number``; what is older than the snapshot before it goes."""
        self._write(self.status(), "snapshots", number)
        fs, _ = tables._hadoop(self.spark, self.home)
        before = [n for n in self._numbers("snapshots") if n < number]
        for kind, oldest in (("epochs", before[0] if before else 0), ("snapshots", before[0] if before else 0)):
            for n in self._numbers(kind):
                if n < oldest or (kind == "epochs" and n == oldest):
                    fs.delete(tables._hadoop(self.spark, versioned.numbered_file(f"{self.home}/{kind}", n))[1], False)
                    fs.delete(tables._hadoop(self.spark, f"{self.home}/{kind}/n={n}")[1], True)

    def status(self) -> DataFrame:
        """The latest status of each id (id, status, updated_at); of equal times the later epoch counts."""
        base = next(iter(self.good("snapshots")), 0)
        later = [n for n in self.good("epochs") if n > base]
        parts = ([self._rows("snapshots", [base])] if base else []) + ([self._rows("epochs", later)] if later else [])
        if not parts:
            return self.spark.createDataFrame([], ROWS)
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        last = F.max_by(F.struct("status", "updated_at"), F.struct("updated_at", "n"))
        return rows.groupBy("id").agg(last.alias("last")).select("id", "last.status", "last.updated_at")

    def lost(self) -> list[int]:
        """Epochs since the snapshot in use whose rows are unreadable."""
        base = next(iter(self.good("snapshots")), 0)
        good = set(self.good("epochs"))
        return sorted(n for n in self._numbers("epochs") if n > base and n not in good)

    def pending(self, expected: DataFrame) -> DataFrame:
        """Expected ids that are neither completed nor failed (O-J14)."""
        return joins.pending(expected, self.status())

    def progress(self, total: int) -> dict:
        """Completed, failed and remaining ids of ``total`` expected ones."""
        counts = {r["status"]: r["n"] for r in self.status().groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()}
        done, failed = counts.get("completed", 0), counts.get("failed", 0)
        return {"completed": done, "failed": failed, "remaining": total - done - failed}

    # Tables of the run: profiles, splits.

    def save(self, df: DataFrame, name: str, keys: list[str]) -> int:
        """Keep a table of the run; the newest save of a key counts."""
        seq = F.lit(len(versioned.numbers(self.spark, f"{self.home}/tables/{name}/versions")))
        return versioned.merge(df.withColumn("_seq", seq), f"{self.home}/tables/{name}", keys, buckets=8)

    def load(self, name: str) -> DataFrame | None:
        """A table of the run as it was saved last, None if it never was."""
        if not versioned.latest(self.spark, f"{self.home}/tables/{name}")[0]:
            return None
        return versioned.read(self.spark, f"{self.home}/tables/{name}").drop("_seq")

    def run(self, expected: DataFrame, work: Callable[[DataFrame], DataFrame], interval: int, clock: Callable[[], int], told: Callable[[dict], None] | None = None) -> dict:
        """Do what is pending in parts of about ``interval`` ids, each an epoch when it is done (O-T02, O-X05).

        ``work`` takes the ids of a part and returns their outcomes (id, status).  A run that is stopped loses the part it was
        at; the next one goes on from there.  ``told`` gets the progress after every part.
        """
        total, left = expected.count(), self.pending(expected)
        parts = max(1, -(-left.count() // interval))
        now = {}
        for i in range(parts):
            # The list of what is left changes as parts are done; which part an id is in doesn't.
            todo = self.pending(expected.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == i))
            self.append(work(todo).select("id", "status", F.lit(clock()).cast("long").alias("updated_at")))
            now = self.progress(total)
            if told:
                told(now)
        return now
