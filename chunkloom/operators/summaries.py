"""Summaries from contexts, by a caller's model or extractive."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom import fixed_values as fv
from chunkloom.functions import prompts, text, urls
from chunkloom.functions.guarded import guard


def _prompts(contexts: DataFrame, tasks: int | None, prompt: dict) -> DataFrame:
    """With `prompt`, null for blank contexts. Contexts are small: Spark would put many of them in one of the `tasks`."""
    if tasks is not None:
        contexts = contexts.repartition(tasks)
    return contexts.withColumn("prompt", F.when(~text.is_blank(F.col("context")), prompts.render(F.col("context"), **prompt)))


def finish(drafted: DataFrame) -> DataFrame:
    """(video_id, context, draft) to (video_id, summary_text, video_url)."""
    # Generated text is cleaned when it comes back and once more before it is
    # stored; the second pass can see a role line which the first one bared.
    clean = text.strip_echo(text.strip_echo(text.or_empty(F.col("draft"))))
    return drafted.select(
        "video_id",
        F.when(text.is_blank(F.col("context")), F.lit(fv.EMPTY_CONTENT)).otherwise(clean).alias("summary_text"),
        urls.video_url(F.col("video_id")).alias("video_url"),
    )


def drafts(contexts: DataFrame, model, tasks: int | None = None, **prompt) -> DataFrame:
    """(video_id, context, draft, error): what the model makes of each prompt; where it fails on one, why."""
    made = _prompts(contexts, tasks, prompt).withColumn("_made", guard(model)(F.col("prompt")))
    return made.select("video_id", "context", F.col("_made.value").alias("draft"), F.col("_made.error").alias("error"))


def summarise(contexts: DataFrame, model=None, tasks: int | None = None, **prompt) -> DataFrame:
    """(video_id, context) to (video_id, summary_text, video_url).

    `model` is a pandas UDF from prompt to generated text; `prompt` holds the
    arguments of `prompts.render`. Without a model the context itself is cut to
    its first sentences. Blank contexts get a fixed text; the model sees null for them.
    `tasks` is the number of tasks that call the model. A prompt that the model fails on ends
    the run; see `drafts` for another way.
    """
    if model is None:
        return finish(contexts.withColumn("draft", F.col("context")))
    return finish(_prompts(contexts, tasks, prompt).withColumn("draft", model(F.col("prompt"))))
