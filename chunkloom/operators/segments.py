"""Transcript segments: filter, type, derive columns, attach videos and images."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.functions import dates, phrases as many, text, urls
from chunkloom.session import stored

# Up to so many phrases are compared one by one, inside the JVM.
FEW_PHRASES = 64
# Phrases of so many bytes together are sent to all tasks; more are joined with the texts.
PHRASE_BYTES = 32 << 20
# Bits that tell where more phrases may occur, for each of them and, as a power of two, for all that are searched at once.
_PHRASE_BITS = 16
_MARK_BITS = 28
# So many places of a text are looked up first; a text where none is a phrase is searched again, without a bound.
_FIRST = 4
UNREAD = "segment file is not valid JSON"
# So many chunk numbers of a video go to one partition.
BLOCK = 1000
# A number as JSON writes it; Spark's own casts also take the suffixes of Java's literals.
_NUMBER = r"^\s*[-+]?(\d+(\.\d*)?|\.\d+)([eE][-+]?\d+)?\s*$"
_WHOLE = r"^\s*[-+]?\d+(\.0*)?\s*$"


def _broken(segments: DataFrame):
    """Whether a row stands for a file that could not be read; it has no text to be judged by."""
    return F.col("broken") if "broken" in segments.columns else F.lit(False)


def strip_and_drop_blank(segments: DataFrame) -> DataFrame:
    stripped = segments.withColumn("text", text.strip(text.or_empty(F.col("text"))))
    return stripped.filter((F.col("text") != "") | _broken(segments))


def _layers(table: DataFrame) -> DataFrame:
    """(raw, phrase) of a table with phrases in its first column: as written and bare, each once."""
    own = F.col(table.columns[0])
    both = F.explode(F.array(*[F.struct(F.lit(raw).alias("raw"), phrase.alias("phrase")) for raw, phrase in ((True, F.lower(own)), (False, text.normalise(own)))]))
    return table.filter(own.isNotNull()).select(both.alias("own")).select("own.*").filter("phrase <> ''").distinct()


def _texts_with(texts: DataFrame, layers: DataFrame) -> DataFrame:
    """The texts that hold a phrase, by joins: runs of letters that may be phrases, by a table of bits, meet the phrases.

    Runs jobs. The bits grow with the phrases up to a bound; beyond it, phrases are searched in several parts. Only
    runs of the lengths that phrases have are joined, with phrases equal to them, so that a join makes no more rows than it reads.
    """
    count = layers.count()
    parts = max(1, -(-count * _PHRASE_BITS // (1 << _MARK_BITS)))
    bits = max(15, min(_MARK_BITS, (count * _PHRASE_BITS).bit_length()))
    written, bare = F.lower("text").alias("written"), text.normalise(F.col("text")).alias("bare")
    distinct = texts.select("text").filter("text is not null").distinct()
    distinct = stored(distinct.select(F.monotonically_increasing_id().alias("id"), "text", written, bare), "texts")
    found = None
    for part in range(parts):
        own = layers.filter(F.pmod(F.xxhash64("phrase"), F.lit(parts)) == part) if parts > 1 else layers
        marks = many.mark(own, bits)
        own = own.select("raw", F.col("phrase").cast("binary").alias("phrase"))
        for most in (_FIRST, None):
            rest = distinct if found is None else distinct.join(found, "id", "left_anti")
            windows = stored(many.marked_windows(rest, marks, most), "phrase-windows")
            met = stored(windows.join(own, ["raw", "phrase"]).select("id").distinct(), "texts-found")
            found = met if found is None else found.union(met)
    return distinct.join(found, "id", "left_semi").select("text")


def drop_stop_phrases(segments: DataFrame, phrases, phrase_bytes: int = PHRASE_BYTES) -> DataFrame:
    """Drop every segment whose text holds one of the phrases, given as texts or as a table with them in its first column.

    A phrase counts where it occurs as written (ignoring case) or after normalising both
    sides. Their number is not limited, and hardly changes the time: an index of them goes to all tasks
    up to `phrase_bytes`, beyond they are joined with the texts. A table is read at once, to tell its size.
    """
    if not isinstance(phrases, DataFrame):
        phrases = list(phrases)
        if len(phrases) <= FEW_PHRASES:
            return segments.filter(~text.has_stop_phrase(F.col("text"), phrases) | _broken(segments)) if phrases else segments
        phrases = segments.sparkSession.createDataFrame([(p,) for p in phrases], "phrase string")
    layers = stored(_layers(phrases), "phrase-layers")
    size = layers.agg(F.sum(F.octet_length("phrase"))).first()[0] or 0
    if size > phrase_bytes:
        found = stored(_texts_with(segments, layers), "texts-with-phrases")
        return segments.join(found.hint("merge"), "text", "left_anti").select(*segments.columns)
    raw, bare = [], []
    for row in layers.toLocalIterator():
        (raw if row.raw else bare).append(row.phrase)
    hit = many.holds_any(segments.sparkSession, (F.lower("text"), raw), (text.normalise(F.col("text")), bare))
    return segments.filter(~hit | _broken(segments))


def type_columns(segments: DataFrame) -> DataFrame:
    """Typed chunk_id, start_s and end_s, plus `reject_reason` where a value cannot be used."""
    number = lambda name: F.when(F.rlike(name, F.lit(_NUMBER)), F.col(name).try_cast("double"))
    whole = F.when(F.rlike("id", F.lit(_WHOLE)), F.regexp_replace("id", r"\..*$", "").try_cast("int"))
    typed = segments.withColumns({"chunk_id": whole, "start_s": number("start"), "end_s": number("end")})
    bad_time = ~F.coalesce(
        dates.has_calendar_time(F.col("start_s")) & dates.has_calendar_time(F.col("end_s")), F.lit(False)
    )
    reason = (
        F.when(_broken(segments), UNREAD)
        .when(F.col("chunk_id").isNull(), "segment id is not an integer")
        .when(bad_time, "start or end is not a time")
    )
    return typed.withColumn("reject_reason", reason).drop("broken")


def accepted(typed: DataFrame) -> DataFrame:
    return typed.filter(F.col("reject_reason").isNull()).drop("reject_reason", "id", "start", "end")


def rejected(typed: DataFrame) -> DataFrame:
    return typed.filter(F.col("reject_reason").isNotNull()).select(
        "video_id", "id", "start", "end", "text", "reject_reason"
    )


def derive_times(segments: DataFrame) -> DataFrame:
    """Time-of-day texts, and the midpoint at which a frame image is taken."""
    return segments.withColumns(
        {
            "start_time": dates.time_of_day(F.col("start_s")),
            "end_time": dates.time_of_day(F.col("end_s")),
            "mid_s": dates.midpoint(F.col("start_s"), F.col("end_s")),
        }
    )


def attach_videos(segments: DataFrame, videos: DataFrame) -> DataFrame:
    """Title and date of its video on each segment; segments of unknown videos go."""
    return segments.join(videos, "video_id")


def attach_images(segments: DataFrame, images: DataFrame, folder: str) -> DataFrame:
    """image_path where `images` (video_id, chunk_id) lists one, else null."""
    known = images.select("video_id", "chunk_id").distinct().withColumn("_has_image", F.lit(True))
    path = urls.image_path(folder, F.col("video_id"), F.col("chunk_id"))
    return (
        segments.join(known, ["video_id", "chunk_id"], "left")
        .withColumn("image_path", F.when(F.col("_has_image"), path))
        .drop("_has_image")
    )


def cluster_by_video(segments: DataFrame, partitions: int | None = None) -> DataFrame:
    """Blocks of neighbouring chunks side by side, in order, a large video over several partitions.

    Later scans group by video: with this layout much of the grouping is done
    before their shuffle. Hashing the block spares the sample that ranges would
    take, which runs all that comes before once more. With a number of
    `partitions`, just as many tasks run what follows.
    """
    key = ["video_id", "chunk_id"]
    block = F.floor(F.col("chunk_id") / BLOCK)
    placed = segments.repartition(*([partitions] if partitions else []), "video_id", block)
    return placed.sortWithinPartitions(*key)


def count_segments(segments: DataFrame) -> DataFrame:
    return segments.groupBy("video_id").agg(F.count("*").alias("segments"))
