"""Records out of model output: arrays, lines, verdicts, with repairs, all of them native expressions. Repairs stand in branches
that are evaluated for rows alone that don't parse as they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import unused
from ..functions.text import normalise, py_strip
from .vote import Profile, valid_category


def strip_fence(x: Column) -> Column:
    """Without a code fence around the whole text."""
    t = py_strip(F.coalesce(x, F.lit("")))
    t = F.regexp_replace(t, r"(?iU)^```(?:jsonl?)?\s*", "")
    return py_strip(F.regexp_replace(t, r"(?U)\s*```$", ""))


def _array(x: Column) -> Column:
    """The text as a variant where it is a JSON array, else null."""
    v = F.try_parse_json(x)
    return F.when(F.schema_of_variant(v).startswith("ARRAY"), v)


def json_array(raw: Column) -> Column:
    """The whole text, else from the first [ to the last ]; null where neither is an array."""
    t = strip_fence(raw)
    return F.coalesce(_array(t), _array(F.regexp_extract(t, r"(?s)(\[.*\])", 1)))


def batch_items(df: DataFrame, raw: str = "raw_output") -> DataFrame:
    """df's columns with ordinal and item for every object of the array; other items are skipped but keep their ordinal."""
    arr, items = unused(df, "arr", "items")
    d = df.withColumn(arr, json_array(F.col(raw)))
    d = d.withColumn(items, F.expr(f"try_variant_get({arr}, '$', 'array<variant>')")).drop(arr)
    out = d.select(*[f"`{c}`" for c in df.columns], F.posexplode(items).alias("ordinal", "item"))
    return out.where(F.schema_of_variant("item").startswith("OBJECT"))


def raw_rows(df: DataFrame, model: str, raw: str = "raw_output") -> DataFrame:
    """Rows of a batch (batch_id, raw_output): clean_text, final_category, item_id and provenance."""
    got = batch_items(df, raw)
    field = lambda name: F.coalesce(F.expr(f"try_variant_get(item, '$.{name}', 'string')"), F.lit(""))
    return got.select(
        normalise(field("clean_text")).alias("clean_text"), py_strip(field("final_category")).alias("final_category"), F.lit(model).alias("generation_model"), "batch_id",
        F.format_string("%s__item_%02d", F.col("batch_id"), F.col("ordinal")).alias("item_id"), F.lit("").alias("parse_error"),
    )


def records(raw: Column) -> Column:
    """array<variant> from an array or, failing that, one JSON value a line, trailing commas dropped; null on any bad line."""
    t = strip_fence(raw)
    lines = F.filter(F.transform(F.split(t, r"\r\n|\n|\r"), lambda x: F.regexp_replace(F.trim(x), r",+$", "")), lambda x: x != "")
    parsed = F.transform(lines, F.try_parse_json)
    whole = F.when((F.size(parsed) > 0) & ~F.exists(parsed, lambda v: v.isNull()), parsed)
    return F.coalesce(F.try_variant_get(json_array(raw), "$", "array<variant>"), whole)


def balanced_object(t: Column) -> Column:
    """The first {...} whose braces balance, or the text; braces in strings count, as the source format's readers do. A fold over
    the stretches that end in a brace."""
    rest = F.substr(t, F.greatest(F.instr(t, "{"), F.lit(1)))
    state = lambda depth, n, done: F.struct(depth.cast("int").alias("depth"), n.cast("int").alias("n"), done.alias("done"))

    def step(s: Column, piece: Column) -> Column:
        depth = s["depth"] + F.when(piece.endswith("{"), 1).otherwise(-1)
        return F.when(s["done"], s).otherwise(state(depth, s["n"] + F.length(piece), depth == 0))

    end = F.aggregate(F.regexp_extract_all(rest, F.lit(r"[^{}]*[{}]"), F.lit(0)), state(F.lit(0), F.lit(0), F.lit(False)), step)
    return F.when(t.startswith("{") | (F.instr(t, "{") == 0), t).when(end["done"], F.substr(rest, F.lit(1), end["n"])).otherwise(t)


def _fenced(t: Column) -> Column:
    """The first fenced block, ```json before plain ```."""
    j, p = F.regexp_extract(t, r"(?s)```json(.+?)```", 1), F.regexp_extract(t, r"(?s)```(.+?)```", 1)
    return F.when(t.contains("```json"), F.when(j != "", py_strip(j)).otherwise(t)).when(t.contains("```"), F.when(p != "", py_strip(p)).otherwise(t)).otherwise(t)


def _closed(t: Column) -> Column:
    """With the missing closing braces, where the text breaks off after a string."""
    s = F.regexp_replace(t, r"\s+$", "")
    lack = F.regexp_count(s, F.lit(r"\{")) - F.regexp_count(s, F.lit(r"\}"))
    return F.when(s.endswith('"') & (lack > 0), F.concat(s, F.lit("\n"), F.repeat(F.lit("}"), lack.cast("int")))).otherwise(t)


def verdicts(df: DataFrame, raw: str = "raw", profile: Profile | None = None) -> DataFrame:
    """df with a model's verdict, read as tolerantly as can be: violation, category, confirmed_label, confidence,
    reasoning, usable, label_match, risk_level, audit_action, reason_code, error.

    With a profile, category and violation are put in order as vote.validated does: a category outside the taxonomy leaves
    no violation and an error, a neutral one none. Only a JSON boolean is a violation. confirmed_label is the category
    where the model gives none; usable and label_match are texts, for they come as booleans or as words. What can't
    be read is the neutral category with an error, and its reasoning holds the start of the raw text."""
    t_, v_, got_ = unused(df, "t", "v", "got")
    body = _fenced(py_strip(F.coalesce(F.col(raw), F.lit(""))))
    d = df.withColumn(t_, body).withColumn(v_, F.try_parse_json(t_))
    t, v = F.col(t_), F.col(v_)
    cut = balanced_object(t)
    closed = _closed(cut)
    loose = F.regexp_replace(F.regexp_replace(closed, r",\s*\}", "}"), r",\s*\]", "]")
    d = d.withColumn(v_, F.when(v.isNotNull(), v).otherwise(F.coalesce(F.try_parse_json(cut), F.try_parse_json(closed), F.try_parse_json(loose))))
    d = d.withColumn(v_, F.when(F.schema_of_variant(v_).startswith("OBJECT"), v))
    get = lambda name, kind="string": F.try_variant_get(v_, f"$.{name}", kind)
    read = v.isNotNull()
    said = F.when(F.schema_of_variant(F.try_variant_get(v_, "$.violation", "variant")) == "BOOLEAN", get("violation", "boolean"))
    neutral = profile.neutral if profile else None
    category, violation, error = get("category"), said, F.lit(None).cast("string")
    if profile:
        valid = valid_category(get("category"), profile)
        category = F.when(valid.isNull() | ~read, neutral).otherwise(valid)
        is_neutral = valid == neutral
        category = F.when(said == F.lit(False), neutral).otherwise(category)
        violation = F.when(valid.isNull(), None).when(is_neutral, False).otherwise(said)
        error = F.when(valid.isNull(), F.concat(F.lit("Invalid category from model: "), get("category"))).when(~is_neutral & said.isNull(), "Missing or invalid violation field from model")
    blank = lambda name: F.coalesce(get(name), F.lit(""))
    fields = F.struct(
        F.when(read, violation).cast("boolean").alias("violation"), category.alias("category"), F.coalesce(get("confirmed_label"), category).alias("confirmed_label"),
        F.coalesce(get("confidence").try_cast("double"), F.lit(0.0)).alias("confidence"),
        F.when(read, blank("reasoning")).otherwise(F.concat(F.lit("Failed to parse JSON response after 3 attempts. Raw: "), F.left(F.coalesce(F.col(raw), F.lit("")), F.lit(500)))).alias("reasoning"),
        get("usable").alias("usable"), get("label_match").alias("label_match"), blank("risk_level").alias("risk_level"), blank("audit_action").alias("audit_action"), blank("reason_code").alias("reason_code"),
        F.when(~read, "JSON parse error: could not extract valid JSON from response").otherwise(error).alias("error"),
    )
    kept = [f"`{c}`" for c in df.columns]
    return d.select(*kept, fields.alias(got_)).select(*kept, f"{got_}.*")
