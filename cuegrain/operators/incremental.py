"""Runs that process only the records added or changed since the last successful run.

A run sees a snapshot (one row per key). Keys are put in order, and the order is cut at
stored split points into at most ``16 ** depth`` key ranges of about equal size, the
leaves of a Merkle tree; records with near keys share a leaf. A leaf's digest is an
order-free combination (two xor lanes and a count) of its records' digests, so that it
comes out of one map-side combined aggregation; an inner node's digest is a SHA-256 over
its children. A run compares the new tree with the saved one from the root, descends only
where digests differ, reads the records of the changed leaves alone, and keeps those that
are new or changed.

The tree has at most ``16 ** depth`` leaves however many records there are, and
``depth`` is at most 4, so that the driver holds it in a few MB. Records never come
to the driver, but for a bounded sample of keys from which split points are chosen. They
are chosen anew where a range has outgrown the others, or where the state was kept with
another depth; such a run compares with all saved records, so that nothing is taken twice.

Published state is append-only. A run writes its records (with the mark
``taken_now``, i.e. the run's output), sorted by leaf, below a name of its own and then
creates one commit file, which holds the tree and names the records: output and tree appear
together or not at all. A run that fails before leaves only unreferenced files. A
commit number exists once, so that of two concurrent runs one fails. Where the live
records have come to lie below many names, the next run gathers them first.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FANOUT_BITS = 4

#: Keys in the sample that split points are chosen from, for each range wanted.
SAMPLED_KEYS = 8
#: A range has outgrown the others with so many records and with so many times its share.
OUTGROWN_ROWS, OUTGROWN = 256, 8
#: Names that live records may lie below before they are gathered.
MAX_HOLDERS = 64


class ConcurrentRunError(RuntimeError):
    """Another run published the same commit number first."""


def record_digest(columns: list[str], seed: int) -> Column:
    """A 64-bit digest of the columns; nulls count as values of their own."""
    parts: list[Column] = [F.lit(seed)]
    for name in columns:
        parts += [F.col(name).isNull(), F.col(name)]
    return F.xxhash64(*parts)


def ordered_key(snapshot: DataFrame, key: list[str]) -> Column:
    """The key columns as one string in an order that keeps near keys near; a null comes before all values."""
    parts = []
    for name in key:
        kind = snapshot.schema[name].dataType
        value = F.col(name)
        if isinstance(kind, T.TimestampType):
            value, kind = F.unix_micros(value), T.LongType()
        if isinstance(kind, T.IntegralType):
            value = F.lpad((value.cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")).cast("string"), 20, "0")
        parts.append(F.coalesce(F.concat(F.lit("\x01"), value.cast("string")), F.lit("\x00")))
    return F.concat_ws("\x00", *parts)


def bisected(values: list, kind: str, wanted: Column, strictly: bool = False) -> Column:
    """How many of the values (ascending) are at most, or strictly below, the wanted one; by halving, in the JVM."""
    if not values:
        return F.lit(0)
    array = F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")
    steps = F.array(*[F.lit(1 << k) for k in range(len(values).bit_length() - 1, -1, -1)])

    def place(value: Column) -> Column:
        def step(at: Column, by: Column) -> Column:
            cut = F.try_element_at(array, at + by)
            return F.when(cut < value if strictly else cut <= value, at + by).otherwise(at)

        return F.aggregate(steps, F.lit(0), step)

    # Bound by a lambda, the wanted value is worked out once a row, not once a step.
    return F.transform(F.array(wanted), place)[0]


def split_points(keys: DataFrame, leaves: int) -> list[str]:
    """Cuts between at most so many key ranges of about equal size, from a sample of SAMPLED_KEYS keys for each.

    keys has a column k. The sample is that of the least hashes, so that it depends on the keys alone.
    """
    rows = keys.select("k").orderBy(F.xxhash64("k"), "k").limit(SAMPLED_KEYS * leaves).collect()
    sample = sorted({r["k"] for r in rows})
    if len(sample) <= leaves:
        return sample[1:]
    return sorted({sample[len(sample) * i // leaves] for i in range(1, leaves)} - {sample[0]})


def leaf_digests(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(leaf, a, b, n): digest lanes and record count of every key range: as many rows as ranges, whatever the size of the snapshot."""
    lanes = [F.bit_xor(record_digest(columns, seed)).alias(name) for name, seed in (("a", 11), ("b", 13))]
    return rows.groupBy("leaf").agg(*lanes, F.count(F.lit(1)).alias("n"))


Tree = list[dict[int, str]]


def grow_tree(leaves: dict[int, str], depth: int) -> Tree:
    """Digests by level from the root (index 0) to the leaves (index ``depth``)."""
    levels: Tree = [leaves]
    for _ in range(depth):
        kids: dict[int, list[str]] = {}
        for node, digest in sorted(levels[0].items()):
            kids.setdefault(node >> _FANOUT_BITS, []).append(f"{node}:{digest}")
        levels.insert(0, {node: hashlib.sha256("|".join(parts).encode()).hexdigest() for node, parts in kids.items()})
    return levels


def changed_leaves(now: Tree, saved: Tree | None) -> list[int]:
    """Leaves whose digests differ, found from the root downwards.

    A node is looked at only if its parent differs. Without a saved tree all leaves
    differ. Leaves that exist only in the saved tree hold no current record and are
    not returned.
    """
    if saved is None:
        return sorted(now[-1])
    frontier = [0]
    for level in range(len(now)):
        nodes = frontier if level == 0 else [kid for node in frontier for kid in range(node << _FANOUT_BITS, (node + 1) << _FANOUT_BITS)]
        frontier = [node for node in nodes if node in now[level] and now[level][node] != saved[level].get(node)]
    return frontier


@dataclass(frozen=True)
class Commit:
    """What one successful run published. splits: the cuts between leaves; owner: the ``ver`` that holds the records of each leaf."""

    number: int
    run: str
    ver: str
    depth: int
    splits: list[str]
    leaves: dict[int, str]
    owner: dict[int, str]

    def tree(self) -> Tree:
        return grow_tree(self.leaves, self.depth)

    def to_json(self) -> str:
        held: dict[str, list[int]] = {}
        for leaf, ver in self.owner.items():
            held.setdefault(ver, []).append(leaf)
        return json.dumps({"number": self.number, "run": self.run, "ver": self.ver, "depth": self.depth, "splits": self.splits, "leaves": self.leaves, "held": held})

    @staticmethod
    def of(text: str) -> Commit:
        raw = json.loads(text)
        owner = {leaf: ver for ver, leaves in raw.pop("held").items() for leaf in leaves}
        return Commit(**raw | {"leaves": {int(n): v for n, v in raw["leaves"].items()}, "owner": owner})


class IncrementalRuns:
    """The state of a consumer, kept below ``root`` in a folder that all executors share.

    key: columns that name a record. version: columns whose change makes a record
    changed; two nulls are equal. ``ready`` (a boolean column of the snapshot, or None
    for always) says whether the record's present version may be taken; a record that
    isn't ready keeps the version taken last, so that coming back to that very
    version is no change.

    Nulls in key columns are values. Repeated rows of a key must be reduced before
    (:func:`latest_versions`). An empty snapshot publishes an empty run. State kept with
    another depth is laid out anew by the next run.
    """

    def __init__(self, spark: SparkSession, root: str, key: list[str], version: list[str], ready: str | None = None, depth: int = 3) -> None:
        clash = {"leaf", "ver", "taken_now", "run"} & {*key, *version}
        if clash:
            raise ValueError(f"column names in use by the state: {sorted(clash)}")
        if not 1 <= depth <= 4:
            raise ValueError("depth is 1 to 4")
        self.spark, self.root, self.key, self.version, self.ready, self.depth = spark, root.rstrip("/"), list(key), list(version), ready, depth
        self._read: dict[int, Commit] = {}

    # -- files -----------------------------------------------------------------
    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def _numbers(self) -> list[int]:
        fs, at = self._fs(f"{self.root}/commits")
        if not fs.exists(at):
            return []
        names = [x.getPath().getName() for x in fs.listStatus(at)]
        return sorted(int(name[:-5]) for name in names if name.endswith(".json") and not name.startswith("."))

    def _commit(self, number: int) -> Commit:
        if number not in self._read:
            fs, path = self._fs(f"{self.root}/commits/{number:08d}.json")
            stream = fs.open(path)
            try:
                self._read[number] = Commit.of(bytes(stream.readAllBytes()).decode())
            finally:
                stream.close()
        return self._read[number]

    def commits(self) -> list[Commit]:
        """All published runs in order."""
        return [self._commit(n) for n in self._numbers()]

    def _publish(self, commit: Commit) -> None:
        fs, final = self._fs(f"{self.root}/commits/{commit.number:08d}.json")
        if fs.exists(final):
            raise ConcurrentRunError(f"commit {commit.number} exists")
        fs, draft = self._fs(f"{self.root}/commits/.{uuid.uuid4().hex}")
        stream = fs.create(draft, True)
        try:
            stream.write(bytearray(commit.to_json().encode()))
        finally:
            stream.close()
        if not fs.rename(draft, final):
            fs.delete(draft, False)
            raise ConcurrentRunError(f"commit {commit.number} exists")
        self._read[commit.number] = commit

    # -- one run ---------------------------------------------------------------
    def run(self, snapshot: DataFrame, run: str, fail_before_publish: bool = False) -> Commit | None:
        """Process a snapshot; returns the commit, or None where the run was made to fail.

        Reads the snapshot for the digests, and the records of the changed leaves once more.
        """
        numbers = self._numbers()
        last = self._commit(numbers[-1]) if numbers else None
        if last and len(set(last.owner.values())) > MAX_HOLDERS:
            last = self.compact()
        number = (last.number if last else 0) + 1
        ver = f"{number:08d}-{uuid.uuid4().hex[:8]}"
        kept = last is not None and last.depth == self.depth
        splits = last.splits if kept else self._splits(snapshot)
        current = self._current(snapshot, splits)
        leaves, sizes = self._digests(current)
        if kept and self._outgrown(sizes):
            kept, splits = False, self._splits(snapshot)
            current = self._current(snapshot, splits)
            leaves, _ = self._digests(current)
        changed = changed_leaves(grow_tree(leaves, self.depth), last.tree() if kept else None)
        self._extract(current, splits, changed, last, kept, ver)
        if fail_before_publish:
            return None
        # A leaf that hasn't changed, or that the snapshot no longer has, keeps its records where they are.
        owner = last.owner | dict.fromkeys(changed, ver) if kept else dict.fromkeys(range(len(splits) + 1), ver)
        commit = Commit(number, str(run), ver, self.depth, splits, leaves, owner)
        self._publish(commit)
        return commit

    def _splits(self, snapshot: DataFrame) -> list[str]:
        return split_points(snapshot.select(ordered_key(snapshot, self.key).alias("k")), 1 << _FANOUT_BITS * self.depth)

    def _outgrown(self, sizes: dict[int, int]) -> bool:
        share = sum(sizes.values()) / (1 << _FANOUT_BITS * self.depth)
        return max(sizes.values(), default=0) > max(OUTGROWN_ROWS, OUTGROWN * share)

    def _leaf(self, rows: DataFrame, splits: list[str]) -> Column:
        return bisected(splits, "string", ordered_key(rows, self.key))

    def _current(self, snapshot: DataFrame, splits: list[str]) -> DataFrame:
        ready = F.coalesce(F.col(self.ready), F.lit(False)) if self.ready else F.lit(True)
        return snapshot.select(*self.key, *self.version, ready.alias("_ready"), self._leaf(snapshot, splits).alias("leaf"))

    def _digests(self, current: DataFrame) -> tuple[dict[int, str], dict[int, int]]:
        rows = leaf_digests(current, [*self.key, *self.version, "_ready"]).collect()
        return {r["leaf"]: f"{r['a']:x}:{r['b']:x}:{r['n']}" for r in rows}, {r["leaf"]: r["n"] for r in rows}

    def _extract(self, current: DataFrame, splits: list[str], changed: list[int], last: Commit | None, kept: bool, ver: str) -> None:
        """Write the records of the changed leaves: the version taken last, and whether this run takes it."""
        current = current.filter(_among("leaf", changed, len(splits) + 1))
        if last is None:
            self._write(current.filter("_ready").select(*self.key, *self.version, "leaf", F.lit(True).alias("taken_now")), ver)
            return
        # Where the layout changes, every saved record takes part and gets its new leaf.
        taken = self._live(last, changed if kept else None, current)
        taken = taken if kept else taken.withColumn("leaf", self._leaf(taken, splits))
        # Both sides meet in one shuffle; a key has at most one row of each.
        now = current.select(*self.key, "leaf", F.struct("_ready", *self.version).alias("_now"), F.lit(None).alias("_old"))
        old = taken.select(*self.key, "leaf", F.lit(None).alias("_now"), F.struct(*self.version).alias("_old"))
        both = now.union(old).groupBy("leaf", *self.key).agg(F.max("_now").alias("_now"), F.max("_old").alias("_old"))
        takes, known = F.coalesce(F.col("_now._ready"), F.lit(False)), F.col("_old").isNotNull()
        same = F.lit(True)
        for v in self.version:
            same = same & F.col(f"_now.`{v}`").eqNullSafe(F.col(f"_old.`{v}`"))
        merged = both.filter(takes | known).select(
            *self.key,
            *[F.when(takes, F.col(f"_now.`{v}`")).otherwise(F.col(f"_old.`{v}`")).alias(v) for v in self.version],
            "leaf",
            (takes & ~(known & same)).alias("taken_now"),
        )
        self._write(merged, ver)

    def _write(self, records: DataFrame, ver: str) -> None:
        """Files sorted by leaf, so that a reader of few leaves skips the other row groups by their statistics."""
        records.sortWithinPartitions("leaf").write.parquet(f"{self.root}/records/ver={ver}")

    def _live(self, commit: Commit, leaves: list[int] | None, like: DataFrame | None = None) -> DataFrame:
        """The live records of a commit, of the named leaves or all."""
        held: dict[str, list[int]] = {}
        for leaf in commit.owner if leaves is None else leaves:
            if leaf in commit.owner:
                held.setdefault(commit.owner[leaf], []).append(leaf)
        records = self._records(sorted(held), like)
        return records.filter(" OR ".join(f"(ver = '{ver}' AND leaf IN ({','.join(map(str, mine))}))" for ver, mine in sorted(held.items())) or "false")

    def _records(self, vers: list[str], like: DataFrame | None = None) -> DataFrame:
        """Records below the named ``ver``."""
        if like is None:
            schema = self.spark.read.parquet(f"{self.root}/records/ver={vers[0]}").schema
        else:
            schema = like.select(*self.key, *self.version, F.lit(0).alias("leaf"), F.lit(True).alias("taken_now")).schema
        schema = schema.add("ver", "string")
        if not vers:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/records")
        return reader.parquet(*[f"{self.root}/records/ver={v}" for v in vers])

    # -- results ---------------------------------------------------------------
    def output(self) -> DataFrame:
        """What each published run took: run, key, version."""
        done = self.commits()
        if not done:
            raise ValueError("no run has been published")
        runs = self.spark.createDataFrame(pa.table({"ver": [c.ver for c in done], "run": [c.run for c in done]}))
        return self._records([c.ver for c in done]).filter("taken_now").join(F.broadcast(runs), "ver").select("run", *self.key, *self.version)

    def compact(self) -> Commit:
        """Gather the live records of all runs in one place; takes nothing."""
        last = self.commits()[-1]
        ver = f"{last.number + 1:08d}-{uuid.uuid4().hex[:8]}"
        live = self._live(last, None).select(*self.key, *self.version, "leaf", F.lit(False).alias("taken_now"))
        self._write(live, ver)
        commit = Commit(last.number + 1, "compaction", ver, last.depth, last.splits, last.leaves, dict.fromkeys(last.owner, ver))
        self._publish(commit)
        return commit


def _among(column: str, values: list[int], of: int) -> Column:
    """Whether the column is one of the values, all of which lie below ``of``."""
    if len(values) == of:
        return F.lit(True)
    return F.expr(f"{column} IN ({','.join(map(str, values))})") if values else F.lit(False)


def latest_versions(log: DataFrame, key: list[str], order: list[str], keep: list[str]) -> DataFrame:
    """One row per key: the kept columns of the row that is greatest by ``order``.

    Repeated rows and ties are settled by the kept columns themselves. The maximum is
    combined before the shuffle, so a key that holds a large share of the log sends
    one row from each task.
    """
    best = F.max(F.struct(*order, *[c for c in keep if c not in order])).alias("_best")
    return log.groupBy(*key).agg(best).select(*key, *[F.col(f"_best.{c}").alias(c) for c in keep])
