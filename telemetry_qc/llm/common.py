"""Helpers shared by the operators of this subpackage.

Inputs are read by exact column name and position, so further columns, also
ones whose names differ only in case or equal a name used inside, never clash.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..paths import fresh_path

DOC_COLUMNS = {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"}

#: Rows of a table of keys that may be broadcast: 1M x 64 bytes = 64 MB.
BROADCAST_ROWS = 1_000_000

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that
    workers need not find it on their own path."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="tqc-ship-"), "telemetry_qc_package.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """The named columns, cast; an absent one is null.  Exact name first,
    then any spelling; all other columns are left out."""
    names = df.columns
    flat = df.toDF(*(f"_{i}" for i in range(len(names))))
    out = []
    for name, kind in types.items():
        at = [i for i, n in enumerate(names) if n == name] or [
            i for i, n in enumerate(names) if n.lower() == name.lower()
        ]
        column = F.col(f"_{at[0]}") if at else F.lit(None)
        out.append(column.cast(kind).alias(name))
    return flat.select(*out)


def documents(df: DataFrame, *names: str) -> DataFrame:
    return pick(df, {n: DOC_COLUMNS[n] for n in names or DOC_COLUMNS})


#: Shuffle files go when the query that wrote them has ended, not when the
#: driver happens to collect its garbage.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: cuts the lineage and is
    there for every executor, also after one is lost.  What the write has
    shuffled is not needed after it."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    schema = df.schema
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEAN)
        else:
            spark.conf.set(_CLEAN, before)
    return spark.read.schema(schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a saved table) marked for broadcast if it has at most ``rows``
    rows, otherwise as it is, for Spark to join by a shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


#: Type of a document's key: 38 digits, the doc_id above 62 bits of a hash.
KEY = "decimal(38,0)"
_SHIFT = 10**19
#: Below every doc_id, above the least that fits.
_NO_ID = -95 * 10**17


def text_hashes(text="text"):
    """Two hashes of the text, 128 bits, as ``one`` and ``two``."""
    body = F.coalesce(F.col(text), F.lit(""))
    return [F.xxhash64(body).alias("one"), F.xxhash64(F.lit(1), body).alias("two")]


def order_key(doc_id="doc_id", text="text"):
    """One number that tells documents apart and keeps the order of their
    doc_ids, whatever these are: the doc_id above 62 bits of a hash of the
    text.  Documents with a null doc_id come first, in the order of the
    hash."""
    body = F.coalesce(F.col(text), F.lit(""))
    ident = F.coalesce(F.col(doc_id).cast("decimal(19,0)"), F.lit(Decimal(_NO_ID)))
    place = F.xxhash64(body).bitwiseAND(F.lit(2**62 - 1)).cast("decimal(19,0)")
    return (ident.cast("decimal(38,0)") * F.lit(Decimal(_SHIFT)).cast("decimal(20,0)") + place).cast(KEY)


def key_doc_id(key):
    """The doc_id of an ``order_key``; null where there was none."""
    ident = F.floor(F.col(key).cast("decimal(38,0)") / F.lit(Decimal(_SHIFT)).cast("decimal(20,0)"))
    return F.when(F.col(key) >= F.lit(Decimal(-(2**63) * _SHIFT)).cast(KEY), ident.cast("long"))
