"""Stored search answers taken in as a table: read, checked, matched to the entities asked, without a loop on the driver.

For answers that were collected elsewhere (a batch interface, an earlier run's log). Each answer is judged as the search loop judges it, by
expressions over JSON variants: the first break of the schema, in the order of its items, fails the whole answer; of items the first of
each id asked counts. The outcomes are those of operators.search.spend for the same answers.

Defined results: a null or blank text is an empty answer; null grounding columns count as empty; an entity asked in several
answers has an outcome of each; an object that repeats a key cannot be read; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.urls import let
from tessera.schemas import ITEM

TEXTS = "array<string>"
#: Columns of an answer: the ids asked (cache keys) and what the provider gave.
ANSWER = "ids array<string>, text string, entry_point boolean, queries array<string>, uris array<string>"


def object_text(text: Column) -> Column:
    """From the first { to the last }; an empty text if there is none."""
    return F.regexp_extract(text, r"(?s)(\{.*\})", 1)


def member(value: Column, name: str) -> Column:
    """A member of a variant object: null if it is missing, a variant null if it is a JSON null."""
    return F.try_variant_get(value, f"$.{name}", "variant")


def kind(value: Column) -> Column:
    """The type of a variant by its first word, an empty text if it is missing."""
    return F.coalesce(F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0), F.lit(""))


def is_text(value: Column) -> Column:
    return kind(value) == "STRING"


def elements(value: Column) -> Column:
    """The elements of a variant array, none of anything else."""
    return F.coalesce(F.when(kind(value) == "ARRAY", F.try_variant_get(value, "$", "array<variant>")), F.array().cast("array<variant>"))


def are_texts(value: Column) -> Column:
    """Whether a variant is missing or a list of texts."""
    return value.isNull() | ((kind(value) == "ARRAY") & F.forall(elements(value), is_text))


def first_error(errors: Column) -> Column:
    """The first that is not null."""
    return F.get(F.filter(errors, lambda e: e.isNotNull()), F.lit(0))


def link_error(link: Column) -> Column:
    confidence = member(link, "confidence")
    number = kind(confidence).isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")
    within = F.coalesce(F.try_variant_get(confidence, "$", "double").between(0, 1), F.lit(False))
    return (
        F.when((kind(link) != "OBJECT") | ~(is_text(member(link, "platform")) & is_text(member(link, "url")) & is_text(member(link, "evidence"))), "a link lacks a field")
        .when(~(number & within), "a confidence is not between 0 and 1")
        .when(~are_texts(member(link, "source_urls")), "a list of texts is expected")
    )


def item_error(item: Column) -> Column:
    name, vague, links = member(item, "canonical_name"), member(item, "ambiguous"), member(item, "links")
    own = (
        F.when((kind(item) != "OBJECT") | ~is_text(member(item, "entity_id")), "an item has no entity_id")
        .when(~(name.isNull() | kind(name).isin("STRING", "VOID")) | ~(vague.isNull() | (kind(vague) == "BOOLEAN")), "an item has a field of a wrong type")
        .when(links.isNotNull() & (kind(links) != "ARRAY"), "links is no list")
    )
    lists = F.when(~are_texts(member(item, "ambiguity_notes")) | ~are_texts(member(item, "aliases_used")), "a list of texts is expected")
    return F.coalesce(own, first_error(F.transform(elements(links), link_error)), lists)


def read_item(item: Column) -> Column:
    """An item that has no error, with defaults filled in."""
    texts = lambda name: F.coalesce(F.try_variant_get(item, f"$.{name}", TEXTS), F.array().cast(TEXTS))
    word = lambda value, name: F.try_variant_get(value, f"$.{name}", "string")

    def link(value: Column) -> Column:
        sources = F.coalesce(F.try_variant_get(value, "$.source_urls", TEXTS), F.array().cast(TEXTS))
        return F.struct(word(value, "platform").alias("platform"), word(value, "url").alias("url"), F.try_variant_get(value, "$.confidence", "double").alias("confidence"), word(value, "evidence").alias("evidence"), F.lit("search").alias("source"), sources.alias("source_urls"))

    made = F.struct(
        word(item, "entity_id").alias("entity_id"),
        word(item, "canonical_name").alias("canonical_name"),
        F.coalesce(F.try_variant_get(item, "$.ambiguous", "boolean"), F.lit(False)).alias("ambiguous"),
        texts("ambiguity_notes").alias("ambiguity_notes"),
        texts("aliases_used").alias("aliases_used"),
        F.transform(elements(member(item, "links")), link).alias("links"),
    )
    return made.cast(ITEM)


def grounding(answers: DataFrame) -> DataFrame:
    """answers with search_used, search_queries and grounding_sources."""
    texts = lambda c: F.filter(F.coalesce(c, F.array().cast(TEXTS)), lambda x: x.isNotNull())
    queries = F.array_distinct(F.filter(F.transform(texts("queries"), lambda q: F.regexp_replace(q, r"(?U)^\s+|\s+$", "")), lambda q: q != ""))
    sources = F.array_distinct(F.filter(texts("uris"), lambda u: u.startswith("http://") | u.startswith("https://")))
    used = (F.size(queries) > 0) | (F.size(sources) > 0) | F.coalesce("entry_point", F.lit(False))
    return answers.withColumns({"search_used": used, "search_queries": queries, "grounding_sources": sources})


def checked(answers: DataFrame, require_grounding: bool = True) -> DataFrame:
    """answers with error (null for a sound answer) and items; from grounding()."""
    text = F.coalesce("text", F.lit(""))
    payload = answers.withColumn("object", object_text(text)).withColumn("payload", F.try_parse_json("object"))
    payload = payload.withColumn("results", member(F.col("payload"), "results"))
    listed = elements(F.col("results"))
    error = (
        F.when(F.lit(require_grounding) & ~F.col("search_used"), "GroundingMissing: the answer cites no search")
        .when(F.regexp_replace(text, r"(?U)\s+", "") == "", "InvalidResponse: the answer is empty")
        .when(F.col("object") == "", "InvalidResponse: no JSON object in the answer")
        .when(F.col("payload").isNull(), "InvalidResponse: the answer's JSON cannot be read")
        .when(F.col("results").isNotNull() & (kind(F.col("results")) != "ARRAY"), "InvalidResponse: results is no list")
        .otherwise(F.concat(F.lit("InvalidResponse: "), first_error(F.transform(listed, item_error))))
    )
    judged = payload.withColumn("error", error)
    return judged.withColumn("items", F.when(F.col("error").isNull(), F.transform(listed, read_item))).drop("object", "payload", "results")


def outcomes(answers: DataFrame, require_grounding: bool = True) -> DataFrame:
    """One row for each id asked: cache_key, event (item, missing or error), item, error and the grounding of its answer."""
    plain = answers.select(*(F.col(c.split()[0]) for c in ANSWER.split(", ")))
    read = checked(grounding(plain), require_grounding)
    # Only the items of an answer are searched for an id: no join, and an answer is never larger than what one call returns.
    asked = read.withColumn("cache_key", F.explode(F.array_distinct("ids")))
    item = let(F.filter("items", lambda i: i["entity_id"] == F.col("cache_key")), lambda found: F.get(found, F.lit(0)))
    rows = asked.withColumn("item", item)
    event = F.when(F.col("error").isNotNull(), "error").when(F.col("item").isNotNull(), "item").otherwise("missing")
    sound = F.col("error").isNull()
    none = F.array().cast(TEXTS)
    return rows.select(
        "cache_key", event.alias("event"), "item", "error",
        F.when(sound, F.col("search_used")).alias("search_used"), F.when(sound, F.col("search_queries")).otherwise(none).alias("search_queries"), F.when(sound, F.col("grounding_sources")).otherwise(none).alias("grounding_sources"),
    )
