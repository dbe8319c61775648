"""Images of office files, described once each however many files show them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.calls import in_order
from tidemark.storage import materialize

#: Image bytes to a description.
Describe = Callable[[bytes], str]


def described(loaded: DataFrame, keys: Sequence[str], describe: Describe, concurrency: int = 1, rate: float | None = None) -> DataFrame:
    """Documents of ``load.load(..., images=True)`` with a description, or else a placeholder, where their images stand; the column ``images`` goes.

    Equal bytes are one image: it moves once from each task that holds it, and the model is called once for it. Images that are too small, can't be read or whose call fails (alone) or answers nothing keep their placeholder.
    ``loaded`` is read more than once, so it should be a table.
    """

    @F.arrow_udf("string")
    def ask(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for some in parts:
            texts = [text for text, _ in in_order(some.to_pylist(), describe, concurrency, rate)]
            yield pa.array([" ".join(t.split()) or None if t else None for t in texts], pa.string())

    found = loaded.where(F.size("images") > 0).select(*keys, F.explode("images").alias("i")).select(*keys, "i.*")
    asked = found.where("content is not null").groupBy("sha").agg(F.any_value("content").alias("content"))
    texts = materialize(asked.select("sha", ask.asNondeterministic()(F.col("content")).alias("text")), "images")
    places = found.select(*keys, "place", "label", "otherwise", F.when(F.col("content").isNotNull(), F.col("sha")).alias("sha"))
    # rows without an image to ask for would all meet in one task
    known = places.where("sha is not null").join(texts, "sha", "left").unionByName(places.where("sha is null"), allowMissingColumns=True)
    shown = F.coalesce(F.concat(F.lit("**["), F.col("label"), F.lit("]**: "), F.col("text")), F.col("otherwise"))
    by_doc = known.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("place", shown.alias("text")))), lambda x: x.text).alias("_t"))
    # every second piece is an image's number: no XML can hold the character that stands around it
    pieces = F.transform(F.split("markdown", r"\x00", -1), lambda x, i: F.when(i % 2 == 0, x).otherwise(F.get(F.col("_t"), x.cast("int"))))
    return loaded.drop("images").join(by_doc, list(keys), "left").withColumn("markdown", F.when(F.col("_t").isNotNull(), F.array_join(pieces, "")).otherwise(F.col("markdown"))).drop("_t")
