"""Replies of an external text model: reading them, asking again, and routing what stays invalid."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpot.functions.text import SPACE, empty_to_null
from stockpot.operators.search import not_done
from stockpot.session import cut


def strip(text: Column) -> Column:
    """A text without white space at its ends."""
    return F.regexp_replace(text, rf"^{SPACE}|{SPACE}$", "")


def choice_content(choice: Column) -> Column:
    """The text of a reply's choice given as JSON text: its content, else the texts of its parts, else its own text."""
    v = F.try_parse_json(choice)
    content = F.try_variant_get(v, "$.message.content", "string")
    whole = F.when(F.schema_of_variant(F.try_variant_get(v, "$.message.content", "variant")) == "STRING", content)
    part = lambda p: F.coalesce(
        F.when(F.schema_of_variant(p) == "STRING", F.try_variant_get(p, "$", "string")),
        F.when(F.schema_of_variant(F.try_variant_get(p, "$.text", "variant")) == "STRING", F.try_variant_get(p, "$.text", "string")),
        F.try_variant_get(p, "$.text.value", "string"),
    )
    parts = F.filter(F.transform(F.try_variant_get(v, "$.message.content", "array<variant>"), lambda p: strip(part(p))), lambda t: t != "")
    filled = lambda t: F.when(strip(t) != "", t)
    return F.coalesce(filled(whole), empty_to_null(F.array_join(parts, "\n")), filled(F.try_variant_get(v, "$.text", "string")), F.lit(""))


def without_fence(text: Column) -> Column:
    """A reply without the code fence around it."""
    return strip(F.regexp_replace(F.regexp_replace(strip(text), r"^```[^\n]*\n", ""), r"\n\s*```[^\n]*$", ""))


def parsed_reply(text: Column) -> Column:
    """recipe as JSON text, summary and error of a reply; text after the object is allowed."""
    v = F.try_parse_json(without_fence(text))
    recipe = F.try_variant_get(v, "$.recipe", "variant")
    is_object = F.coalesce(F.schema_of_variant(recipe).startswith("OBJECT"), F.lit(False))
    told = F.try_variant_get(v, "$.summary", "variant")
    error = F.when(v.isNull(), "model output was not valid JSON").when(~F.schema_of_variant(v).startswith("OBJECT"), "model output must be a JSON object").when(~is_object, 'model output must include a "recipe" object').when(told.isNotNull() & (F.schema_of_variant(told) != "STRING"), 'model output "summary" must be a string if present')
    return F.struct(F.when(is_object, F.to_json(recipe)).alias("recipe"), F.try_variant_get(v, "$.summary", "string").alias("summary"), error.alias("error"))


def request_payload(document: Column, model: str, instructions: str, feedback: Column | None = None) -> Column:
    """The request to a text model as JSON text: instructions, the document as JSON text, and what was wrong with the last reply.

    feedback: null for a first request.
    """
    told = document if feedback is None else F.when(feedback.isNull(), document).otherwise(F.concat(F.lit("Validation error:\n"), feedback, F.lit("\n\nCurrent candidate:\n"), document))
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    kind = F.struct(F.lit("json_object").alias("type"))
    return F.to_json(F.struct(F.lit(model).alias("model"), F.array(message("system", F.lit(instructions)), message("user", told)).alias("messages"), F.lit(0.2).alias("temperature"), kind.alias("response_format")))


def ask(requests: DataFrame, call: Callable[[str], str], key: str, attempts: int = 2) -> DataFrame:
    """key, content, calls: the replies of an injected callable, asked again while its content is blank."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for k, payload in zip(frame[key], frame["payload"], strict=True):
                content, calls = "", 0
                while not content.strip() and calls < attempts:
                    content, calls = call(payload) or "", calls + 1
                rows.append((k, content, calls))
            yield pd.DataFrame(rows, columns=[key, "content", "calls"])

    return requests.select(key, "payload").mapInPandas(run, f"{key} {dict(requests.dtypes)[key]}, content string, calls int")


def route(candidates: DataFrame, errors: Column, retried: Column) -> DataFrame:
    """candidates with route: valid, retry (once, with the errors), or manual."""
    return candidates.withColumn("route", F.when(F.size(errors) == 0, "valid").when(~retried, "retry").otherwise("manual"))


def improve(documents: DataFrame, call: Callable[[str], str], model: str, instructions: str, check: Callable[[DataFrame], DataFrame], key: str = "id") -> DataFrame:
    """key, recipe, summary, errors, route of documents (key, document as JSON text) that a model improves.

    check: from key and recipe to key and errors (array). A reply that can't be read or breaks
    a rule is asked for once more, with what is wrong with it; what stays so is left to people.
    """

    def turn(requests: DataFrame, name: str) -> DataFrame:
        replied = cut(ask(requests, call, key), name)
        read = replied.select(key, parsed_reply(F.col("content")).alias("_r")).select(key, "_r.*")
        found = read.join(check(read.where("error is null").select(key, "recipe")).select(key, F.col("errors").alias("_e")), key, "left")
        none = F.array().cast("array<string>")
        return cut(found.select(key, "recipe", "summary", F.when(F.col("error").isNotNull(), F.array("error")).otherwise(F.coalesce("_e", none)).alias("errors")), name)

    first = turn(documents.select(key, request_payload(F.col("document"), model, instructions).alias("payload")), "first")
    wrong = first.where(F.size("errors") > 0)
    again = wrong.join(documents.select(key, "document"), key).select(key, request_payload(F.coalesce("recipe", "document"), model, instructions, F.array_join("errors", "\n")).alias("payload"))
    second = turn(again, "second")
    done = first.where(F.size("errors") == 0).withColumn("_again", F.lit(False)).unionByName(second.withColumn("_again", F.lit(True)))
    return route(done, F.col("errors"), F.col("_again")).drop("_again")


def work_through(items: DataFrame, state: DataFrame, work: Callable[[DataFrame], DataFrame], batch: int = 1_000, key: str = "id") -> DataFrame:
    """The state (kind, id, seq) after all items that it lacks were worked on, a batch after the other in the order of their keys.

    work: from items to key and written, whether the result was kept. What fails counts as
    reviewed too, so that it does not come again. Each batch's state is written before the next.
    """
    while True:
        done = state.where("kind = 'reviewed'").select(F.col("id").alias(key))
        some = cut(not_done(items, done, key).orderBy(key).limit(batch), "batch")
        if not some.take(1):
            return state
        result = some.select(key).join(work(some).select(key, "written"), key, "left")
        start = state.agg(F.coalesce(F.max("seq") + 1, F.lit(0)).alias("s")).first().s
        new = result.select(F.lit("reviewed").alias("kind"), F.col(key).cast("string").alias("id"), F.lit(start).cast("long").alias("seq"))
        kept = result.where("written").select(F.lit("written").alias("kind"), F.col(key).cast("string").alias("id"), F.lit(start).cast("long").alias("seq"))
        state = cut(state.unionByName(new).unionByName(kept), "state")


def merge_state(state: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """A resume state with new ids, each once in the order of its first seq."""
    return state.unionByName(new).groupBy(key).agg(F.min("seq").alias("seq"))


