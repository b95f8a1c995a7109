"""Structured Streaming.

R1: the batch loaders run once per micro-batch inside ``foreachBatch``.
Every load is idempotent (anti joins on keys, timeline rule for
satellites), so a micro-batch retried after an executor or driver loss adds
nothing twice, and the checkpoint keeps the source offsets.  Rows that a
load refuses are written to the target's rejects table.

R2: re-delivered rows are dropped before the load, either by the rows that
are stored already (whatever their age), or within a time limit by Spark's
state store.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strongroom.operators.hub import hub_rejects, load_hub
from strongroom.operators.link import link_rejects, load_link
from strongroom.operators.sat_store import SatStore
from strongroom.operators.satellite import load_sat, sat_rejects
from strongroom.operators.specs import HubSpec, LinkSpec, SatSpec
from strongroom.sources.io import append, counted, overwrite, read_or_none


@dataclass
class VaultTarget:
    """Where one entity lives, where refused rows go, and how it is loaded.

    A satellite in timeline mode is stored by load date (``SatStore``), so
    that a micro-batch reads only the partitions from its first day on."""

    spec: HubSpec | LinkSpec | SatSpec
    path: str
    rejects: str
    mode: str = "timeline"

    def read(self, spark: SparkSession) -> DataFrame | None:
        """The stored rows; None before the first load."""
        if isinstance(self.spec, SatSpec) and self.mode == "timeline":
            return SatStore(spark, self.path, self.spec).read()
        return read_or_none(spark, self.path)


#: One row of the accounts: every delivered row is refused, loaded, or absorbed
#: as a repetition (an equal key, or a version equal to the one before).
ACCOUNT = "TARGET string, DELIVERED long, REFUSED long, LOADED long, ABSORBED long"


def vault_batch_loader(targets: Sequence[VaultTarget], accounts: str | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function loading hubs, then links, then satellites.

    The refused rows of a batch and target are written to a folder of their
    own, ``<rejects>/BATCH_ID=<n>``, which a retry overwrites.  With
    ``accounts`` a batch's row counts per target go to ``<accounts>/BATCH_ID=<n>``;
    the writing jobs count them, so they cost no further pass.  (A
    micro-batch tried again loads only what is missing, and accounts the rest as absorbed.)
    """
    order = {HubSpec: 0, LinkSpec: 1, SatSpec: 2}
    ordered = sorted(targets, key=lambda t: order[type(t.spec)])

    def load(batch: DataFrame, t: VaultTarget) -> int:
        spark = batch.sparkSession
        if isinstance(t.spec, SatSpec) and t.mode == "timeline":
            return SatStore(spark, t.path, t.spec).load(batch)
        if isinstance(t.spec, SatSpec):
            new = load_sat(batch, t.read(spark), t.spec, mode=t.mode)
        else:
            new = (load_hub if isinstance(t.spec, HubSpec) else load_link)(batch, t.read(spark), t.spec)
        return counted(new, lambda df: append(df, t.path))

    def run(batch: DataFrame, batch_id: int) -> None:
        refuse = {HubSpec: hub_rejects, LinkSpec: link_rejects, SatSpec: sat_rejects}
        batch = batch.persist()  # read once, for all targets
        delivered, rows = batch.count(), []  # fills the cache
        for t in ordered:
            loaded = load(batch, t)
            refused = counted(refuse[type(t.spec)](batch, t.spec), lambda df: overwrite(df, f"{t.rejects}/BATCH_ID={batch_id}"))
            rows.append((t.spec.name, delivered, refused, loaded, delivered - refused - loaded))
        if accounts:
            overwrite(batch.sparkSession.createDataFrame(rows, ACCOUNT), f"{accounts}/BATCH_ID={batch_id}")
        batch.unpersist()

    return run


def stream_load(
    stream: DataFrame,
    targets: Sequence[VaultTarget],
    checkpoint: str,
    available_now: bool = True,
    accounts: str | None = None,
) -> StreamingQuery:
    """Start a micro-batch vault load of ``stream`` into ``targets``."""
    w = stream.writeStream.foreachBatch(vault_batch_loader(targets, accounts)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def redelivery_filter(stream: DataFrame, keys: Sequence[str], event_ts: str, hours: int = 96) -> DataFrame:
    """R2 with bounded state: drop rows delivered again within ``hours`` of
    event time.  The key must include the event time: A -> B -> A is three
    versions and must stay so.  Spark's watermark drops rows older than that
    as well; where late rows may come, use ``unseen_sink``, which keeps them."""
    wm = "_wm_ts"
    s = stream.withColumn(wm, F.col(event_ts).cast("timestamp")).withWatermark(wm, f"{int(hours)} hours")
    return s.dropDuplicatesWithinWatermark(list(keys) + [wm]).drop(wm)


def unseen_sink(path: str, keys: Sequence[str], event_ts: str) -> Callable[[DataFrame, int], None]:
    """R2: ``foreachBatch`` sink appending the rows of a micro-batch whose keys
    and event time are not stored yet, however late they come.  Only the
    stored rows between the batch's first and last event time are compared.
    A retried micro-batch adds nothing twice."""
    full = [*keys, event_ts]

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        new = batch.dropDuplicates(full)
        stored = read_or_none(batch.sparkSession, path)
        if stored is not None:
            lo, hi = batch.agg(F.min(event_ts), F.max(event_ts)).first()
            seen = stored.select(*full)
            if lo is not None:  # rows without an event time are compared as well
                seen = seen.filter(F.col(event_ts).between(F.lit(lo), F.lit(hi)) | F.col(event_ts).isNull())
            same = F.lit(True)
            for c in full:
                same = same & F.col(f"n.{c}").eqNullSafe(F.col(f"s.{c}"))
            new = new.alias("n").join(seen.alias("s"), same, "left_anti")
        append(new, path)
        batch.unpersist()

    return run
