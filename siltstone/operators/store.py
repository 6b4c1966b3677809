"""Runs, pointers, content and the lifecycle of an index, on plain files of any Hadoop file system.

The state of a run is the fold of its own append-only log; the content of a run becomes visible, all its tables at once,
by a commit file that names their folders; pointers are appended too, the last one holds. One writer per index holds a
lease that it renews and that lapses with its holder. Nothing needs an atomic rename.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from datetime import UTC, datetime, timedelta
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.operators.folder import Folder

STATES = ("created", "crawling", "embedding", "verifying", "complete", "activated", "superseded", "rejected", "error")
UNFINISHED = ("created", "crawling", "embedding", "verifying")
PRUNABLE = ("complete", "superseded", "rejected", "error")
VERDICTS = ("pass", "caution", "fail")
CONTENT = ("sources", "documents", "chunks", "centroids", "diffs", "verifications", "reports")
#: The folders that each version of the layout added.
FOLDERS = {1: ("runs", "pointers", "leases", "commits"), 2: ("attestations",)}
LAYOUT = max(FOLDERS)
#: Seconds that a lease holds without being renewed.
LEASE = 120
RUN_EVENTS = "run_id string, index_name string, state string, verdict string, metadata string, event string, at timestamp, position long"


class LifecycleError(RuntimeError):
    """A transition that the state of a run forbids."""


def fold_runs(events: DataFrame) -> DataFrame:
    """The current row of each run: last state, last known verdict, merged metadata, and the times of transitions."""
    order = F.struct("at", "position")
    when = lambda state: F.max(F.when(F.col("state") == state, F.col("at")))
    return events.groupBy("run_id").agg(
        F.min_by("index_name", order).alias("index_name"),
        F.max_by("state", order).alias("lifecycle_status"),
        F.max_by("verdict", F.when(F.col("verdict").isNotNull(), order)).alias("verification_verdict"),
        F.min("at").alias("started_at"),
        F.max(F.when(F.col("state").isin("complete", "error"), F.col("at"))).alias("finished_at"),
        when("activated").alias("activated_at"),
        when("rejected").alias("rejected_at"),
        F.max_by("metadata", F.when(F.col("metadata").isNotNull(), order)).alias("metadata"),
    )


def folded(events: list[dict]) -> dict | None:
    """fold_runs() of the events of one run."""
    if not events:
        return None
    events = sorted(events, key=lambda e: (e["at"], e["position"]))
    last = lambda name: next((e[name] for e in reversed(events) if e.get(name) is not None), None)
    when = lambda *states: max((e["at"] for e in events if e["state"] in states), default=None)
    return {
        "run_id": events[0]["run_id"], "index_name": events[0]["index_name"], "lifecycle_status": events[-1]["state"], "verification_verdict": last("verdict"),
        "started_at": events[0]["at"], "finished_at": when("complete", "error"), "activated_at": when("activated"), "rejected_at": when("rejected"), "metadata": last("metadata"),
    }


def latest(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Upsert semantics over an append-only table: the last row of each key."""
    rank = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(rank)).filter("rank = 1").drop("rank")


def listed_runs(runs: DataFrame, index_name: str | None = None, limit: int = 50) -> DataFrame:
    found = runs if index_name is None else runs.filter(F.col("index_name") == index_name)
    return found.orderBy(F.desc("started_at"), F.desc("id")).limit(limit)


def stale_runs(runs: DataFrame, now, minutes: int = 360) -> DataFrame:
    """Unfinished runs that started more than `minutes` ago."""
    return runs.filter(F.col("lifecycle_status").isin(*UNFINISHED) & (F.col("started_at") < F.lit(now) - F.make_dt_interval(mins=F.lit(minutes))))


def prune_candidates(runs: DataFrame, indexes: DataFrame, older_than=None, statuses: list[str] | None = None, keep_last: int | None = None, index_names: list[str] | None = None, only_disabled: bool | None = None) -> DataFrame:
    """Runs that may be deleted: all given criteria hold, and neither a live nor a previous live pointer names them.
    keep_last ranks over all runs of an index, live ones too. At least one criterion is needed."""
    if older_than is None and not statuses and keep_last is None:
        raise ValueError("pruning needs an age, states or a number of runs to keep")
    rank = Window.partitionBy("index_name").orderBy(F.desc("started_at"), F.desc("id"))
    ranked = runs.dropDuplicates(["id"]).withColumn("newest", F.row_number().over(rank))
    pointers = indexes.select(F.col("name").alias("index_name"), "live_run_id", "previous_live_run_id").distinct()
    found = ranked.join(pointers, "index_name").filter(~F.col("id").eqNullSafe(F.col("live_run_id")) & ~F.col("id").eqNullSafe(F.col("previous_live_run_id")))
    found = found.filter(F.col("lifecycle_status").isin(*(statuses or PRUNABLE)))
    if older_than is not None:
        found = found.filter(F.coalesce("finished_at", "started_at") < F.lit(older_than))
    if keep_last is not None:
        found = found.filter(F.col("newest") > keep_last)
    if index_names is not None:
        found = found.filter(F.col("index_name").isin(*index_names))
    if only_disabled is not None:
        found = found.filter(F.coalesce(F.get_json_object("metadata", "$.embeddings_disabled").cast("boolean"), F.lit(False)) == only_disabled)
    return found.orderBy("index_name", "started_at", "id").drop("newest")


def orphaned(verifications: DataFrame, pruned: DataFrame) -> DataFrame:
    """(input_hash) that only pruned runs refer to."""
    of_pruned = verifications.join(pruned.select("run_id"), "run_id", "left_semi").select("input_hash").distinct()
    of_others = verifications.join(pruned.select("run_id"), "run_id", "left_anti").select("input_hash").distinct()
    return of_pruned.join(of_others, "input_hash", "left_anti").filter("input_hash is not null")


def referenced(attestations: DataFrame, verifications: DataFrame, pruned: DataFrame) -> DataFrame:
    """Attestations to keep after pruning: all but those that only pruned runs refer to."""
    return attestations.join(orphaned(verifications, pruned), "input_hash", "left_anti")


def trusted_result(attestations: DataFrame, trusted: list[str]) -> DataFrame:
    """For each input the attestation of the first trusted attestor, the newest of one."""
    place = F.array_position(F.array(*[F.lit(t) for t in trusted]), F.col("attestor"))
    return latest(attestations.withColumn("place", place).filter("place > 0"), ["input_hash"], [F.col("place"), F.desc("created_at"), F.desc("attestor")]).drop("place")


def upserted_attestations(rows: DataFrame) -> DataFrame:
    """One row for each (input_hash, attestor): first creation, last use, latest payload."""
    return rows.groupBy("input_hash", "attestor").agg(F.min("created_at").alias("created_at"), F.max("last_used_at").alias("last_used_at"), F.max_by("payload", F.struct("last_used_at", "payload")).alias("payload"))


class Store:
    """The folders of one installation. clock is injected for tests."""

    def __init__(self, spark: SparkSession, root: str, clock: Callable[[], datetime] = lambda: datetime.now(UTC).replace(tzinfo=None)):
        self.spark, self.root, self.clock = spark, root, clock
        self.folder = Folder(spark, root)
        self.migrate()

    def migrate(self) -> int:
        """Bring the folders to the layout this code writes, step by step from the version they have; returns that of
        the layout. Folders of a newer layout are refused."""
        held = int(self.folder.read("version") or 0)
        if held > LAYOUT:
            raise LifecycleError(f"the store has layout {held}, this code knows {LAYOUT}")
        for version in range(held + 1, LAYOUT + 1):
            for name in FOLDERS[version]:
                self.folder.make(name)
            self.folder.write(str(version), "version")
        return LAYOUT

    def _json(self, schema: str, *names: str) -> DataFrame:
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(self.folder.name(*names))

    def _append(self, row: dict, *names: str) -> str:
        """row, with its position, as the last file of a folder."""
        position = time.time_ns()
        file = f"{position:020d}-{uuid.uuid4().hex}.json"
        self.folder.write(json.dumps({"position": position} | row, default=lambda x: x.isoformat(sep=" ")), *names, file)
        return file

    def _rows(self, *names: str) -> list[dict]:
        return [json.loads(self.folder.read(*names, n)) for n in self.folder.list(*names) if n.endswith(".json")]

    # log of runs
    def record(self, run_id: str, index: str, state: str | None, event: str, verdict: str | None = None, metadata: dict | None = None) -> None:
        if state is not None and state not in STATES or verdict is not None and verdict not in VERDICTS:
            raise ValueError(f"unknown state or verdict: {state}, {verdict}")
        held = (self.run(run_id) if event != "created" else None) or {}
        merged = json.loads(held.get("metadata") or "{}") | (metadata or {})
        self._append({"run_id": run_id, "index_name": index, "state": state or held.get("lifecycle_status"), "verdict": verdict, "metadata": json.dumps(merged, sort_keys=True), "event": event, "at": self.clock()}, "runs", run_id)

    def events(self) -> DataFrame:
        return self._json(RUN_EVENTS, "runs")

    def runs(self) -> DataFrame:
        return fold_runs(self.events())

    def run(self, run_id: str) -> dict | None:
        """The state of a run from its own log, without a job."""
        return folded([e | {"at": datetime.fromisoformat(e["at"])} for e in self._rows("runs", run_id)])

    def create_run(self, index: str, metadata: dict | None = None) -> str:
        run_id = str(uuid.uuid4())
        self.record(run_id, index, "created", "created", metadata=metadata)
        return run_id

    # content of runs
    def committed(self, run_id: str) -> dict[str, str]:
        """The folder of each table of a run."""
        names = self.folder.list("commits", run_id)
        return json.loads(self.folder.read("commits", run_id, names[-1]))["tables"] if names else {}

    def persist(self, run_id: str, tables: dict[str, DataFrame]) -> None:
        """Write tables of a run; they become visible together, in place of those written before, which are deleted."""
        version, placed = uuid.uuid4().hex, {}
        for table, df in tables.items():
            placed[table] = f"{table}/{run_id}/{version}"
            df.withColumn("run_id", F.lit(run_id)).write.parquet(self.folder.name(placed[table]))
        held = self.committed(run_id)
        self._append({"run_id": run_id, "tables": held | placed}, "commits", run_id)
        for table in set(held) & set(placed):
            self.folder.delete(held[table])

    def write(self, table: str, run_id: str, df: DataFrame) -> None:
        self.persist(run_id, {table: df})

    def read(self, table: str, run_id: str | None = None) -> DataFrame:
        """A table over its runs; a run's rows come from its folder alone. Without any it is empty."""
        from siltstone.operators import schema

        if run_id is not None:
            paths = [p for t, p in self.committed(run_id).items() if t == table]
        else:
            commits = self._json("run_id string, position long, tables map<string,string>", "commits")
            last = commits.groupBy("run_id").agg(F.max_by(F.col("tables")[table], "position").alias("path"))
            paths = [r["path"] for r in last.filter("path is not null").select("path").toLocalIterator()]  # one for each run
        if not paths:
            return schema.empty(self.spark, table)
        return self.spark.read.option("mergeSchema", "true").parquet(*map(self.folder.name, paths))

    def drop_run(self, run_id: str) -> None:
        """Delete a run: first what makes it visible, then its content and its log."""
        for name in ("commits", *CONTENT, "runs"):
            self.folder.delete(name, run_id)

    def save_verification(self, run_id: str, deterministic: str, result: dict, findings: list[dict], attestor: str = "local") -> None:
        from siltstone.operators import schema

        llm = result.get("llm") or {}
        row = (run_id, deterministic, llm.get("verdict"), result["verdict"], [tuple(f[k] for k in ("check", "verdict", "actual", "threshold")) for f in findings], result.get("input_hash"), result["source"], attestor)
        self.persist(run_id, {"verifications": self.spark.createDataFrame([row], schema.TABLES["verifications"]).coalesce(1)})

    def save_report(self, run_id: str, summary: str, text: str) -> None:
        from siltstone.operators import schema

        self.persist(run_id, {"reports": self.spark.createDataFrame([(run_id, summary, text)], schema.TABLES["reports"]).coalesce(1)})

    # results of verifiers
    def attest(self, input_hash: str, attestor: str, payload: dict) -> None:
        """Put down a result, or that it was used again; the first creation stays."""
        now = self.clock()
        held = [r for r in self._rows("attestations", input_hash) if r["attestor"] == attestor]
        created = min((datetime.fromisoformat(r["created_at"]) for r in held), default=now)
        self._append({"input_hash": input_hash, "attestor": attestor, "payload": json.dumps(payload, sort_keys=True), "created_at": created, "last_used_at": now}, "attestations", input_hash)

    def attestations(self) -> DataFrame:
        return upserted_attestations(self._json("input_hash string, attestor string, payload string, created_at timestamp, last_used_at timestamp", "attestations"))

    def attested(self, input_hash: str, attestors: list[str]) -> tuple[str, dict] | None:
        """(attestor, payload): the newest result of the first of the attestors that has one."""
        rows = self._rows("attestations", input_hash)
        for attestor in attestors:
            own = [r for r in rows if r["attestor"] == attestor]
            if own:
                return attestor, json.loads(max(own, key=lambda r: (r["last_used_at"], r["position"]))["payload"])
        return None

    # pointers
    def pointer(self, index: str) -> dict:
        rows = self._rows("pointers", quote(index, safe=""))
        held = rows[-1] if rows else {"name": index, "live_run_id": None, "previous_live_run_id": None}
        return {k: held[k] for k in ("name", "live_run_id", "previous_live_run_id")}

    def point(self, index: str, live: str | None, previous: str | None) -> None:
        folder = quote(index, safe="")
        old = self.folder.list("pointers", folder)
        self._append({"name": index, "live_run_id": live, "previous_live_run_id": previous}, "pointers", folder)
        for name in old[:-1]:
            self.folder.delete("pointers", folder, name)

    def pointers(self) -> DataFrame:
        rows = self._json("name string, live_run_id string, previous_live_run_id string, position long", "pointers")
        last = rows.groupBy("name").agg(F.max_by(F.struct("live_run_id", "previous_live_run_id"), "position").alias("last"))
        return last.select("name", "last.*")

    # transitions
    def activate(self, run_id: str, allow_caution: bool = False) -> None:
        run = self.require(run_id)
        reason = not_activatable(run, allow_caution)
        if reason:
            raise LifecycleError(reason)
        held = self.pointer(run["index_name"])
        if held["live_run_id"] == run_id:
            raise LifecycleError("run is live already")
        self.point(run["index_name"], run_id, held["live_run_id"])
        if held["live_run_id"]:
            self.record(held["live_run_id"], run["index_name"], "superseded", "superseded")
        self.record(run_id, run["index_name"], "activated", "activated")

    def reject(self, run_id: str) -> None:
        run = self.require(run_id)
        held = self.pointer(run["index_name"])
        if run_id in (held["live_run_id"], held["previous_live_run_id"]):
            raise LifecycleError("a live or previous live run can't be rejected")
        self.record(run_id, run["index_name"], "rejected", "rejected")

    def rollback(self, index: str) -> str:
        held = self.pointer(index)
        live, previous = held["live_run_id"], held["previous_live_run_id"]
        if not previous:
            raise LifecycleError("there is no previous live run")
        self.point(index, previous, live)
        if live:
            self.record(live, index, "superseded", "rolled back")
        self.record(previous, index, "activated", "rolled back to")
        return previous

    def prune(self, **criteria) -> list[str]:
        """Delete the runs that prune_candidates() names, and the results of verifiers that only they refer to."""
        runs = self.runs().withColumnRenamed("run_id", "id")
        gone = [r["id"] for r in prune_candidates(runs, self.pointers(), **criteria).select("id").toLocalIterator()]
        if gone:
            pruned = self.spark.createDataFrame([(g,) for g in gone], "run_id string")
            unused = [r["input_hash"] for r in orphaned(self.read("verifications"), pruned).toLocalIterator()]  # one for each pruned run at most
            for run_id in gone:
                self.drop_run(run_id)
            for input_hash in unused:
                self.folder.delete("attestations", input_hash)
        return gone

    def reconcile(self, minutes: int = 360) -> list[str]:
        """Unfinished runs whose index nobody holds any more become errors; those only created when they are stale."""
        changed = []
        for r in self.runs().filter(F.col("lifecycle_status").isin(*UNFINISHED)).toLocalIterator():
            stale = r["started_at"] < self.clock() - timedelta(minutes=minutes)
            if not self.is_locked(r["index_name"]) and (r["lifecycle_status"] != "created" or stale):
                self.record(r["run_id"], r["index_name"], "error", "orphaned")
                changed.append(r["run_id"])
        return changed

    def require(self, run_id: str) -> dict:
        run = self.run(run_id)
        if run is None:
            raise LifecycleError(f"no run {run_id}")
        return run

    # leases
    def lease(self, index: str) -> dict | None:
        """Owner and end of the lease of an index, None if nobody holds it."""
        text = self.folder.read("leases", f"{quote(index, safe='')}.json")
        held = json.loads(text) if text else None
        return held if held and datetime.fromisoformat(held["until"]) >= self.clock() else None

    def is_locked(self, index: str) -> bool:
        return self.lease(index) is not None

    @contextmanager
    def lock(self, index: str, seconds: float = LEASE):
        """Exclusive use of an index; a second holder fails at once. The lease is renewed while it is held, and lapses
        `seconds` after its holder is gone. Yields a check that fails once the lease was lost."""
        owner, file = uuid.uuid4().hex, f"{quote(index, safe='')}.json"

        def put() -> None:
            self.folder.write(json.dumps({"owner": owner, "until": (self.clock() + timedelta(seconds=seconds)).isoformat()}), "leases", file)

        def check() -> None:
            held = self.lease(index)
            if held is None or held["owner"] != owner:
                raise LifecycleError(f"the lease of {index} was lost")

        if self.is_locked(index):
            raise LifecycleError(f"{index} is in use")
        put()
        time.sleep(0.05)
        if (self.lease(index) or {}).get("owner") != owner:  # somebody else wrote at the same time
            raise LifecycleError(f"{index} is in use")
        done = threading.Event()

        def renew() -> None:
            while not done.wait(seconds / 3):
                try:
                    check()
                    put()
                except LifecycleError:
                    return

        keeper = threading.Thread(target=renew, daemon=True)
        keeper.start()
        try:
            yield check
        finally:
            done.set()
            keeper.join()
            if (self.lease(index) or {}).get("owner") == owner:
                self.folder.delete("leases", file)


def not_activatable(run: dict, allow_caution: bool = False) -> str | None:
    """Why a run can't be activated, None if it can."""
    if run["lifecycle_status"] != "complete":
        return f"run is {run['lifecycle_status']}, not complete"
    if json.loads(run.get("metadata") or "{}").get("embeddings_disabled"):
        return "run was embedded without a provider"
    if run["verification_verdict"] == "pass" or run["verification_verdict"] == "caution" and allow_caution:
        return None
    return f"verdict is {run['verification_verdict']}"


def activation_reason(status: Column, metadata: Column, verdict: Column, allow_caution: bool = False) -> Column:
    """not_activatable() over a table of runs."""
    disabled = F.coalesce(F.get_json_object(metadata, "$.embeddings_disabled").cast("boolean"), F.lit(False))
    fit = (verdict == "pass") | (verdict == "caution") if allow_caution else verdict == "pass"
    return (
        F.when(~status.eqNullSafe(F.lit("complete")), F.concat(F.lit("run is "), F.coalesce(status, F.lit("None")), F.lit(", not complete")))
        .when(disabled, "run was embedded without a provider")
        .when(~F.coalesce(fit, F.lit(False)), F.concat(F.lit("verdict is "), F.coalesce(verdict, F.lit("None"))))
    )


def action_column(enabled: Column, first: Column, provider: Column, verdict: Column) -> Column:
    """auto_action() over a table of runs."""
    return F.when(F.coalesce(enabled & ~first & (provider != "noop") & (verdict == "pass"), F.lit(False)), "activate").otherwise("hold")


def auto_action(enabled: bool, first: bool, provider: str, verdict: str) -> str:
    """activate or hold."""
    return "activate" if enabled and not first and provider != "noop" and verdict == "pass" else "hold"
