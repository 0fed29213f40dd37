"""A dictionary of merged parts that is kept across corpora."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftmill.lineage import cut
from weftmill.operators.bpe import merge_parts
from weftmill.operators.text import distinct_parts


class PartDictionary:
    """A stored table `(part, clusters, tokens)` per vocabulary, in a folder that outlives the session.

    A further corpus merges only the parts that no corpus before it had: they are found by an anti-join and
    appended. Entries lie in a partition named by a digest of their vocabulary, so another vocabulary has entries
    of its own and never gets these. One job at a time may extend a folder.
    """

    def __init__(self, spark: SparkSession, folder: str, vocab: DataFrame):
        self.spark, self.vocab = spark, vocab
        digest = vocab.agg(F.bit_xor(F.xxhash64("token", "cluster")).alias("k"), F.count(F.lit(1)).alias("n")).first()
        self.path = f"{folder}/vocabulary={digest['n']}_{(digest['k'] or 0) & (1 << 64) - 1:016x}"

    @property
    def table(self) -> DataFrame:
        """All entries; none before the first corpus."""
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        schema = "part string, clusters array<string>, tokens array<int>"
        if not at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def extend(self, parts: DataFrame) -> int:
        """Merge and append those of the distinct `parts` that have no entry; how many they are."""
        new = cut(parts.select("part").join(self.table.select("part"), "part", "left_anti"))
        n = new.count()
        if n:
            merged = merge_parts(new, self.vocab)
            merged.select("part", "clusters", F.col("tokens").cast("array<int>")).write.mode("append").parquet(self.path)
        return n

    def entries(self, df: DataFrame, text_col: str) -> DataFrame:
        """`(part, n, clusters, tokens)` for every distinct part of a text column, as `tokens.part_dictionary`
        gives; unseen parts are merged and kept."""
        parts = cut(distinct_parts(df, text_col))
        self.extend(parts)
        return parts.join(self.table, "part")
