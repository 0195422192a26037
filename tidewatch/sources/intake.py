"""Landed payload files to raw (bronze) records, each file once.

A run first writes down which files it takes, and only then shapes them:

  <root>/_intake/<source>/plans/0000000002/…    the files of plan 2 and the run's stamp
  <root>/_intake/<source>/_planned/0000000002   made when the list is complete
  <root>/_intake/<source>/_done/0000000002      made when the plan's records are written
  <root>/bronze/<source>/batch_id=2/…           the records, overwritten if the plan runs again

A file belongs to one plan, and a plan always has the same files, stamp and
folder. So a run that dies is taken up where it stopped: its plan is done again
over its own folder, then what has landed since becomes a plan of its own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.sources import publish as PB
from tidewatch.sources import raw as RW
from tidewatch.sources import schemas
from tidewatch.sources.landed import CORRUPT, read_landed_json


@dataclass(frozen=True)
class Payload:
    schema: T.StructType
    shape: Callable[[DataFrame, str], DataFrame]  # payload rows and the run's stamp -> raw records


PAYLOADS = {
    "stocks": Payload(schemas.PRICE_PAYLOAD, lambda df, stamp: RW.price_records(df, stamp)),
    "news": Payload(schemas.NEWS_PAYLOAD, lambda df, stamp: RW.news_records(df, ingested_at=stamp)),
    "fred": Payload(schemas.MACRO_PAYLOAD, lambda df, stamp: RW.macro_records(df, ingested_at=stamp)),
}
_PLAN = "file string, stamp string"


class CorruptPayload(RuntimeError):
    """Raised before a plan is done, when some of its payloads cannot be parsed."""


def _marks(spark: SparkSession, base: str, kind: str) -> list[str]:
    return [n for n in PB._names(spark, f"{base}/{kind}") if n.isdigit()]


def new_files(spark: SparkSession, landing: str, base: str) -> list[str]:
    """Files under ``landing`` that no plan names."""
    fs, p = PB._fs(spark, landing)
    if not fs.exists(p):
        return []
    found = [unquote(f) for f in spark.read.option("recursiveFileLookup", "true").text(landing).inputFiles()]
    planned = [f"{base}/plans/{n}" for n in _marks(spark, base, "_planned")]
    if not found or not planned:
        return sorted(found)
    listed = spark.createDataFrame([(f,) for f in found], "file string")
    return sorted(r.file for r in listed.join(spark.read.schema(_PLAN).json(planned), "file", "left_anti").collect())


def _plan(spark: SparkSession, base: str, files: list[str], stamp: str) -> None:
    name = PB._claim(spark, base)
    spark.createDataFrame([(f, stamp) for f in files], _PLAN).coalesce(1).write.json(f"{base}/plans/{name}")
    PB._create(spark, f"{base}/_planned/{name}")


def take_in(spark: SparkSession, root: str, source: str, landing: str, stamp: str | None = None, strict: bool = True) -> int:
    """Shape what has landed under ``landing`` into ``root/bronze/<source>``; returns the number of payload files taken.

    ``stamp`` is the ingestion time of new files (default: now, UTC). With
    ``strict`` a payload that cannot be parsed stops the run before its plan is
    done, so it is tried again; otherwise such payloads are left out.
    """
    root, kind = root.rstrip("/"), PAYLOADS[source]
    base = f"{root}/_intake/{source}"
    taken = 0
    done = _marks(spark, base, "_done")
    if unfinished := [n for n in _marks(spark, base, "_planned") if n not in done]:
        taken += sum(_run(spark, root, source, kind, base, n, strict) for n in unfinished)
    if files := new_files(spark, landing, base):
        _plan(spark, base, files, stamp or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%S.%f"))
        taken += _run(spark, root, source, kind, base, _marks(spark, base, "_planned")[-1], strict)
    return taken


def _run(spark: SparkSession, root: str, source: str, kind: Payload, base: str, name: str, strict: bool) -> int:
    plan = spark.read.schema(_PLAN).json(f"{base}/plans/{name}").orderBy("file").collect()  # names only
    payloads = read_landed_json(spark, [r.file for r in plan], kind.schema, with_corrupt=True)
    if strict:
        columns = [F.count(F.col(f"`{c}`")) for c in payloads.columns if c != CORRUPT]
        if bad := payloads.agg(F.count(CORRUPT).alias("bad"), *columns).first()["bad"]:
            raise CorruptPayload(f"{source}: {bad} payload(s) cannot be parsed")
    records = kind.shape(payloads.where(F.col(CORRUPT).isNull()).drop(CORRUPT) if not strict else payloads.drop(CORRUPT), plan[0].stamp)
    records.write.mode("overwrite").json(f"{root}/bronze/{source}/batch_id={int(name)}")
    PB._create(spark, f"{base}/_done/{name}")
    return len(plan)
