"""A stream of pages into a registry: state of pages seen, a log of finds, committed versions.

Each batch is worked off in two steps, both of which may be run again without harm:

1. what its pages yield goes to the log of finds, `bucket=<b>/batch=<id>`, where a batch that
   is run again overwrites its own files; a page that the log holds with the same content, from
   any batch, is not mined anew but has its finds copied;
2. the lists of the companies whose sites the batch touched are made from all that the log
   holds of these sites, and a new version of the registry is committed under the batch's
   name, once.

So the registry after any number of batches is the one that a single run over all pages gives.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stewardry.functions.urls import netloc_domain
from stewardry.plans.extraction import process_pages
from stewardry.plans.management import FROM_PAGES, management_of_sites
from stewardry.session import written
from stewardry.sinks.store import RegistryStore

#: Buckets of the log of finds, by site.
BUCKETS = 256

_LOG = "content long, domain string, url string, seq int, name string, role string, email string, phone string, bucket int, batch long"
_CONTENT = ("title", "body_text", "sections")


def new_pages(pages: DataFrame, time: str, lateness: str = "7 days") -> DataFrame:
    """The stream without pages that came before with the same content, and without pages
    whose `time` is more than `lateness` behind the newest seen.

    The state is a hash per page and content, dealt over all tasks, and is dropped when the
    watermark has passed it. Pages delivered again later only cost their work anew.
    """
    content = F.xxhash64(*_CONTENT)
    seen = pages.withColumn("_content", content).withWatermark(time, lateness)
    return seen.dropDuplicatesWithinWatermark(["url", "_content"]).drop("_content")


@dataclass
class RegistryIngest:
    """Where batches of pages go: the store, and the folder of the log of finds."""

    store: RegistryStore
    log: str
    now: Column
    name: str = "ingest"
    source: str = FROM_PAGES
    buckets: int = BUCKETS

    def finds(self) -> DataFrame:
        """The log: a row for each find, and one without a name for a page that has none."""
        return self.store.spark.read.schema(_LOG).parquet(self.log)

    def record(self, pages: DataFrame, batch_id: int) -> None:
        """Step 1: the finds of a batch, in place of those of an earlier attempt."""
        pages = pages.withColumn("content", F.xxhash64(*_CONTENT))
        try:
            log = self.finds()
        except AnalysisException:  # no batch has come yet
            rows = self._mined(pages)
        else:
            same = ["url", "content"]
            # equal pages have equal finds, whatever the batch; an attempt that broke off left
            # all of a page's finds or none
            last = log.where("content IS NOT NULL").groupBy(*same).agg(F.max("batch").alias("batch"))
            held = written(last.join(pages.select(*same), same, "left_semi"), "held-pages")
            copied = log.join(held, [*same, "batch"], "left_semi")
            fresh = pages.join(held.select(*same), same, "left_anti")
            mined = self._mined(fresh)
            rows = mined.unionByName(copied.select(*mined.columns))
        rows = rows.withColumns({
            "bucket": F.pmod(F.xxhash64("domain"), F.lit(self.buckets)).cast("int"), "batch": F.lit(batch_id).cast("long")})
        # a file or a few for each bucket, not one from every task
        rows.hint("rebalance", F.col("bucket")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(self.log)

    def _mined(self, pages: DataFrame) -> DataFrame:
        # the log has no file names; their column takes the content through
        processed = process_pages(pages.withColumn("source_file", F.col("content").cast("string")))
        both = F.concat("executives", "board_members")
        rows = processed.select(
            F.col("source_file").cast("long").alias("content"), netloc_domain("url").alias("domain"), "url", F.posexplode_outer(both).alias("seq", "_p"))
        return rows.select("content", "domain", "url", "seq", "_p.*")

    def updates(self, batch_id: int) -> DataFrame:
        """Step 2: the lists of the companies that a batch touched.

        Of a page that came several times the last batch counts. Only the touched sites'
        buckets are read.
        """
        known = self.finds().where(F.col("batch") <= batch_id)
        touched = known.where(F.col("batch") == batch_id).select("bucket", "domain").distinct()
        history = known.join(touched, ["bucket", "domain"], "left_semi")
        last = F.max("batch").over(Window.partitionBy("url"))
        latest = history.withColumn("_last", last).where("batch = _last AND name IS NOT NULL")
        return management_of_sites(latest, touched, self.store.read(), self.source)

    def apply(self, pages: DataFrame, batch_id: int) -> int:
        """Both steps; the registry's version afterwards."""
        batch = f"{self.name}-{batch_id}"
        if self.store.holds(batch):
            return self.store.version()
        if pages.isEmpty():
            return self.store.version()
        self.record(pages, batch_id)
        return self.store.update_management(written(self.updates(batch_id), "site-updates"), self.now, batch=batch)

    def start(self, pages: DataFrame, checkpoint: str) -> StreamingQuery:
        """Works off everything that is new in a stream of good pages, then stops by itself."""
        return (
            pages.writeStream.foreachBatch(lambda batch, batch_id: self.apply(batch, batch_id) and None)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
