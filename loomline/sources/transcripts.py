"""Transcript JSON as segments: synonyms for lists and fields, first value that isn't empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates
from ..operators.chunking import normalise_segments

# Names under which transcripts keep their lists and fields.
LISTS = ["segments", "transcript", "items", "results"]
TEXT = ["text", "content", "transcript", "sentence"]
START = ["start", "start_time", "timestamp_start"]
END = ["end", "end_time", "timestamp_end"]
SPEAKER = ["speaker", "speaker_name", "speaker_id", "voice", "who"]
DATE = ["episode_date", "date", "published", "published_at", "publish_date"]
VERSION = ["schema_version", "version", "contract_version"]
GLOB = "*_speaker_transcript.json"
# End of the fixed values.

_WORD = T.StructType([T.StructField("speaker", T.StringType())])
_SEGMENT = T.StructType([T.StructField(c, T.StringType()) for c in dict.fromkeys(["id", "segment_id", *TEXT, *START, *END, *SPEAKER])] + [T.StructField("words", T.ArrayType(_WORD))])
_META = T.StructType([T.StructField(c, T.StringType()) for c in DATE])


def _schema(list_name: str | None) -> T.StructType:
    fields = [T.StructField(c, T.StringType()) for c in dict.fromkeys(["text", *DATE, *VERSION])] + [T.StructField("metadata", _META)]
    return T.StructType(fields + [T.StructField(c, T.ArrayType(_SEGMENT)) for c in ([list_name] if list_name else [])])


def _first(fields: list[str], base: str = "") -> Column:
    return F.coalesce(*[F.nullif(F.col(base + f), F.lit("")) for f in fields])


def read_files(spark: SparkSession, path: str, glob: str = GLOB) -> DataFrame:
    """(source, size, modified, value): one row a file below path."""
    text = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(path)
    return text.select(file_path().alias("source"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_modification_time").alias("modified"), "value")


def file_path() -> Column:
    """Path of a row's file, with spaces as spaces."""
    return F.replace(F.col("_metadata.file_path"), F.lit("%20"), F.lit(" "))


def title(source: Column | str) -> Column:
    """File name without its ending."""
    return F.regexp_extract(source, r"([^/\\]+?)(\.[^./\\]*)?$", 1)


def fingerprint() -> Column:
    return F.sha1(F.concat_ws("|", "source", F.col("size").cast("string"), F.unix_micros("modified").cast("string")))


def segments(files: DataFrame) -> DataFrame:
    """Normalised segments of files (source, value): the first list that is there, a bare list, or the whole text as one segment."""
    bare = F.regexp_like("value", F.lit(r"^\s*\["))
    value = F.when(bare, F.concat(F.lit('{"segments":'), F.col("value"), F.lit("}"))).otherwise(F.col("value"))
    lists = [F.from_json(value, _schema(name), {"mode": "PERMISSIVE"})[name] for name in LISTS]
    top = F.from_json(value, _schema(None))
    parsed = files.select("source", top.alias("top"), F.coalesce(*[F.when(F.size(x) > 0, x) for x in lists]).alias("list"))
    date = F.coalesce(_first(DATE, "top."), _first(DATE, "top.metadata."), F.nullif(F.regexp_extract("source", r"20\d{2}[-_/]?\d{2}[-_/]?\d{2}", 0), F.lit("")))
    rows = parsed.select("source", "top", dates.episode_date(date).alias("episode_date"), F.posexplode_outer("list").alias("pos", "s"))
    speakers = F.transform(F.coalesce(F.col("s.words"), F.array().cast(T.ArrayType(_WORD))), lambda w: w["speaker"])
    flat = rows.select(
        "source", "episode_date", F.coalesce("pos", F.lit(0)).alias("segment_index"), _first(TEXT, "s.").alias("text"), F.coalesce(_frequent(speakers), _first(SPEAKER, "s.")).alias("speaker"),
        dates.number(_first(START, "s.")).alias("start_time"), dates.number(_first(END, "s.")).alias("end_time"), F.col("top.text").alias("whole"),
    )
    real = flat.where(F.regexp_like("text", F.lit(r"\S"))).drop("whole")
    alone = flat.where(F.regexp_like("whole", F.lit(r"\S"))).join(real.select("source").distinct(), "source", "left_anti").dropDuplicates(["source"])
    whole = alone.select("source", "episode_date", F.lit(0).alias("segment_index"), F.col("whole").alias("text"), F.lit(None).cast("string").alias("speaker"), *[F.lit(None).cast("double").alias(c) for c in ("start_time", "end_time")])
    return normalise_segments(real.unionByName(whole))


def _frequent(speakers: Column) -> Column:
    """The most frequent word speaker; named ones go before SPEAKER_n."""
    from ..functions.arrays import most_common

    there = F.filter(speakers, lambda s: s.isNotNull() & (s != ""))
    named = F.filter(there, lambda s: ~F.regexp_like(s, F.lit(r"^SPEAKER_\d+$")))
    return F.get(most_common(F.when(F.size(named) > 0, named).otherwise(there), 1), F.lit(0))


def schema_versions(files: DataFrame) -> DataFrame:
    """(source, schema_version) of files (source, value); null where a file can't be read."""
    return files.select("source", F.from_json("value", _schema(None)).alias("v")).select("source", _first(VERSION, "v.").alias("schema_version"))
