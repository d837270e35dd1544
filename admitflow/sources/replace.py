"""Replace a stored directory in one step: the old content is read until the new one is whole."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Both lie beside the directory they belong to; names with an underscore are no data to Spark.
_STAGED, _REPLACED = "_staged", "_replaced"
# Spark's mark of a finished write.
_FINISHED = "_SUCCESS"


@dataclass(frozen=True)
class Slot:
    """A directory of Parquet files that one writer at a time replaces.

    The new content is written beside it. Once whole, the old directory is set aside and the new one takes its name: two
    renames, no data moves. A write that fails or is killed leaves the old content in place; if the writer dies between
    the renames, ``settle`` finishes the exchange from what lies there.
    """

    spark: SparkSession
    path: str

    def _beside(self, folder: str) -> str:
        parent, name = self.path.rstrip("/").rsplit("/", 1)
        return f"{parent}/{folder}/{name}"

    def _path(self, text: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(text)

    def _files(self):
        return self._path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, text: str) -> bool:
        return self._files().exists(self._path(text))

    def _delete(self, text: str) -> None:
        self._files().delete(self._path(text), True)

    def _rename(self, source: str, target: str) -> None:
        files = self._files()
        files.mkdirs(self._path(target).getParent())
        if not files.rename(self._path(source), self._path(target)):
            raise OSError(f"could not rename {source} to {target}")

    def _move_in(self, source: str) -> None:
        try:
            self._rename(source, self.path)
        except Exception:
            # A reader that settles at the same time has moved it already.
            if self._exists(source) or not self._exists(self.path):
                raise

    def write(self, df: DataFrame) -> None:
        """Store ``df``, which may read the old content."""
        self.settle()
        staged = self._beside(_STAGED)
        try:
            df.write.mode("overwrite").parquet(staged)
        except BaseException:
            self._delete(staged)
            raise
        self._exchange()

    def _exchange(self) -> None:
        replaced = self._beside(_REPLACED)
        if self._exists(self.path):
            self._delete(replaced)
            self._rename(self.path, replaced)
        self._move_in(self._beside(_STAGED))
        self._delete(replaced)

    def settle(self) -> None:
        """Finish an exchange that was cut off: forward if the new content is whole, else back."""
        staged, replaced = self._beside(_STAGED), self._beside(_REPLACED)
        if self._exists(self.path) or not self._exists(replaced):
            return
        whole = self._exists(f"{staged}/{_FINISHED}")
        self._move_in(staged if whole else replaced)
        self._delete(replaced)

    def read(self) -> DataFrame:
        self.settle()
        return self.spark.read.parquet(self.path)
