"""Reading landed JSON pages: ``<root>/<resource>/*.json``, one page per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Landing:
    def __init__(self, spark: SparkSession, root: str, whole_files: bool = False):
        """``whole_files``: each file is one, possibly pretty-printed, page."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.whole_files = whole_files

    def path(self, resource: str) -> str:
        return f"{self.root}/{resource}"

    def pages(self, resource: str) -> DataFrame:
        return self.spark.read.text(self.path(resource), wholetext=self.whole_files)

    def page_stream(self, resource: str, files_per_batch: int | None = None) -> DataFrame:
        # a file counts by its name, however old its time stamp is
        reader = self.spark.readStream.option("maxFileAge", "36500d")
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        return reader.text(self.path(resource), wholetext=self.whole_files)
