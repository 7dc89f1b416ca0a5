"""Checks of entities and rules, as issue rows: (entity_id, check, severity, message) with ordinals check_no, entity_no, svc_no."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from doclathe.functions import text as T
from doclathe.runtime import materialize

TYPES = ("airline", "airport")
LEAST = 20
_ISSUE = ("entity_id", "check", "severity", "message", "check_no", "entity_no", "svc_no")


def display_id(name: Column, source: Column) -> Column:
    return F.coalesce(F.when(name != "", name), F.when(source != "", source), F.lit("UNKNOWN"))


def _blank(c: Column) -> Column:
    return F.coalesce(T.strip(c), F.lit("")) == ""


def _issue(check: str, severity: str, message: Column, no: int, svc: Column | None = None) -> Column:
    return F.struct(F.lit(check).alias("check"), F.lit(severity).alias("severity"), message.alias("message"), F.lit(no).alias("check_no"), (svc if svc is not None else F.lit(-1)).cast("int").alias("svc_no"))


def entity_issues(entities: DataFrame, no: str = "entity_no") -> DataFrame:
    """Issues of entities with typed services, all checks in one pass over each row, without a shuffle.

    entity_structure: a blank name, type or source. entity_type: not airline or airport. services_present: null or empty. service_structure: blank
    type, English under 20 characters, blank Romanian. duplicate_types: a type more than once in an entity. A null service is an error."""
    eid = display_id(F.col("entity_name"), F.col("source_id"))
    services = F.coalesce(F.col("services"), F.array().cast(entities.schema["services"].dataType))
    flat = [F.when(_blank(F.col(f)), _issue("entity_structure", "error", F.lit(f"Missing or empty required field: '{f}'"), 1)) for f in ("entity_name", "entity_type", "source_id")]
    got = F.when(F.col("entity_type").isNull(), "None").otherwise(F.concat(F.lit("'"), "entity_type", F.lit("'")))
    flat.append(F.when(~F.coalesce(F.col("entity_type").isin(*TYPES), F.lit(False)), _issue("entity_type", "error", F.concat(F.lit("entity_type must be 'airline' or 'airport', got "), got), 2)))
    flat.append(F.when(F.col("services").isNull(), _issue("services_present", "error", F.lit("Field 'services' is missing or not a list"), 3)))
    flat.append(F.when(F.size("services") == 0, _issue("services_present", "error", F.lit("Entity has an empty services array"), 3)))

    def of_service(s: Column, i: Column) -> Column:
        at = lambda m: F.concat(F.lit("services["), i.cast("string"), F.lit(f"]: {m}"))
        en = F.coalesce(T.strip(s["description"]["en"]), F.lit(""))
        return F.array(
            F.when(s.isNull(), _issue("service_structure", "error", at("is not an object"), 4, i)),
            F.when(s.isNotNull() & _blank(s["type"]), _issue("service_structure", "error", at("'type' is missing or empty"), 4, i)),
            F.when(s.isNotNull() & (F.length(en) < LEAST), _issue("service_structure", "error", at("description.en is missing or too short"), 4, i)),
            F.when(s.isNotNull() & _blank(s["description"]["ro"]), _issue("service_structure", "warning", at("description.ro is empty"), 4, i)),
        )

    types = F.filter(F.transform(services, lambda s: F.lower(T.strip(s["type"]))), lambda t: t != "")
    twice = F.filter(F.transform(F.array_distinct(types), lambda t: F.struct(t.alias("t"), F.size(F.filter(types, lambda u: u == t)).alias("n"))), lambda s: s["n"] > 1)
    double = F.transform(twice, lambda s: _issue("duplicate_types", "warning", F.concat(F.lit("Service type '"), s["t"], F.lit("' appears "), s["n"].cast("string"), F.lit(" times")), 5))
    issues = F.filter(F.concat(F.array(*flat), F.flatten(F.transform(services, of_service)), double), lambda x: x.isNotNull())
    return entities.select(eid.alias("entity_id"), F.col(no).alias("entity_no"), F.explode(issues).alias("i")).select("entity_id", "i.check", "i.severity", "i.message", "i.check_no", "entity_no", "i.svc_no")


def shape_issues(rows: DataFrame, raw: str = "services_json", no: str = "entity_no") -> DataFrame:
    """(entity_no, svc_no, problem) of services kept as JSON, whose shapes a typed schema would hide: not a list, an entry or description that is no
    object, a flag that is no boolean. Invalid JSON and null count as not a list."""
    v = F.try_parse_json(raw)
    kind = F.schema_of_variant(v)
    items = F.when(kind.startswith("ARRAY"), F.from_json(raw, "array<string>"))
    each = rows.select(F.col(no).alias("entity_no"), kind.alias("kind"), F.posexplode_outer(items).alias("svc_no", "s"))
    s = F.try_parse_json("s")
    s_kind = F.coalesce(F.schema_of_variant(s), F.lit("STRING"))
    desc, flag = F.schema_of_variant(F.try_variant_get(s, "$.description", "variant")), F.schema_of_variant(F.try_variant_get(s, "$.is_presented", "variant"))
    problem = (
        F.when(~F.coalesce(F.col("kind").startswith("ARRAY"), F.lit(False)), "services is not a list")
        .when(F.col("svc_no").isNull(), None)
        .when(~s_kind.startswith("OBJECT"), "service is not an object")
        .when(~F.coalesce(desc.startswith("OBJECT"), F.lit(True)), "description is not an object")
        .when(~F.coalesce(flag.isin("BOOLEAN", "VOID"), F.lit(True)), "is_presented is not a boolean")
    )
    return each.select("entity_no", "svc_no", problem.alias("problem")).where("problem is not null")


def summary(issues: DataFrame) -> DataFrame:
    """(check, error, warning) counts."""
    return issues.groupBy("check").agg(F.count_if(F.col("severity") == "error").alias("error"), F.count_if(F.col("severity") == "warning").alias("warning"))


def clean_entities(entities: DataFrame, issues: DataFrame) -> DataFrame:
    """Entities whose display id has no error; entities of one name fall together."""
    bad = issues.where("severity = 'error'").select("entity_id").distinct()
    return entities.withColumn("entity_id_", display_id(F.col("entity_name"), F.col("source_id"))).join(bad, F.col("entity_id_") == F.col("entity_id"), "left_anti").drop("entity_id_")


def totals(entities: DataFrame, issues: DataFrame) -> DataFrame:
    """(total, passed, excluded, pass_rate): the rate in whole per cent, halves to even; null without entities."""
    n = entities.agg(F.count("*").alias("total"))
    ok = clean_entities(entities, issues).agg(F.count("*").alias("passed"))
    t, p = F.col("total"), F.col("passed")
    return n.crossJoin(ok).select("total", "passed", (t - p).alias("excluded"), F.when(t > 0, F.bround(100 * p / t).cast("int")).alias("pass_rate"))


# Words that make a rule's description say little. Our own list.
VAGUE = ("as appropriate", "where applicable", "if necessary", "etc.", "and so on", "may vary")


def rule_issues(rules: DataFrame) -> DataFrame:
    """(rule_id, check, problem) of rules: structure (blank fields, ids other than R and digits), quality (short, in capitals, vague, same as the title)."""
    d, t = T.strip(F.coalesce("description", F.lit(""))), T.strip(F.coalesce("title", F.lit("")))
    found = [F.when(_blank(F.col(f)), F.struct(F.lit("structure").alias("check"), F.lit(f"{f} is missing").alias("problem"))) for f in ("rule_id", "category", "title", "description", "source")]
    found.append(F.when(~F.coalesce(F.col("rule_id").rlike(r"^R\d+\z"), F.lit(True)), F.struct(F.lit("structure").alias("check"), F.lit("rule_id has another form").alias("problem"))))
    for problem, hit in (("description is short", F.length(d) < 30), ("description is in capitals", T.is_upper(d)), ("description is vague", F.lower(d).rlike(T.any_phrase(VAGUE))), ("description repeats the title", F.lower(d) == F.lower(t))):
        found.append(F.when((d != "") & hit, F.struct(F.lit("quality").alias("check"), F.lit(problem).alias("problem"))))
    return rules.select("rule_id", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("i")).select("rule_id", "i.check", "i.problem")


def id_gaps(rules: DataFrame, number: Column) -> DataFrame:
    """(after, before): numbers between which ids are missing. Neighbours are found per range partition; each partition's first number meets the one
    before it through its partition's greatest, so no task holds all rows."""
    nos = rules.select(number.cast("long").alias("n")).where("n is not null").distinct()
    parts = materialize(nos.repartitionByRange("n").withColumn("p", F.spark_partition_id()))
    inner = parts.withColumn("prev", F.lag("n").over(W.partitionBy("p").orderBy("n")))
    edges = parts.groupBy("p").agg(F.max("n").alias("top")).withColumn("before", F.lag("top").over(W.orderBy("p"))).select("p", "before")
    j = inner.join(F.broadcast(edges), "p").withColumn("prev", F.coalesce("prev", "before"))
    return j.where("n - prev > 1").select(F.col("prev").alias("after"), F.col("n").alias("before"))


def unknown_categories(rules: DataFrame, known: list[str]) -> DataFrame:
    """(category, n) of rules whose category isn't known; null is one of them."""
    return rules.where(F.col("category").isNull() | ~F.col("category").isin(*known)).groupBy("category").agg(F.count("*").alias("n"))


def normalised_duplicates(rules: DataFrame) -> DataFrame:
    """(rule_id, n): the least id and number of rules that agree in description, in lower case with single spaces; blank ones aside."""
    d = F.lower(T.collapse(F.col("description")))
    return rules.where(d != "").groupBy(F.md5(d).alias("k")).agg(F.min("rule_id").alias("rule_id"), F.count_distinct("rule_id").alias("n")).where("n > 1").drop("k")


def reject(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """df with rejects: the names of the conditions each row violates."""
    marks = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in conditions.items()]
    return df.withColumn("rejects", F.filter(F.array(*marks), lambda x: x.isNotNull()))


def model_conditions() -> dict[str, Column]:
    """What a record of an airline or airport must hold."""
    text = [~_blank(F.col(f)) for f in ("entity_id", "entity_name", "source_id")]
    typed = F.forall(F.coalesce("services", F.array()), lambda s: ~_blank(s["type"]) & (F.length(T.strip(F.coalesce(s["description"]["en"], F.lit("")))) >= LEAST))
    return {"id": text[0], "name": text[1], "source": text[2], "services": typed}


def failed_entities(entities: DataFrame, issues: DataFrame) -> DataFrame:
    """Entities that an error names."""
    bad = issues.where("severity = 'error'").select(F.col("entity_id").alias("__bad")).distinct()
    return entities.join(bad, display_id(F.col("entity_name"), F.col("source_id")) == F.col("__bad"), "left_semi")


def cross_source(rules: DataFrame) -> DataFrame:
    """(title, sources, texts): titles, case and space aside, under which several sources say different things; candidates for a reviewer or a model to
    judge. Counted by aggregation, so a title on a third of all rules does no harm."""
    key = lambda c: F.lower(T.collapse(F.coalesce(F.col(c), F.lit(""))))
    rows = rules.select(key("title").alias("title"), F.col("source"), key("description").alias("text")).where("title <> '' and text <> '' and source is not null")
    return rows.groupBy("title").agg(F.count_distinct("source").alias("sources"), F.count_distinct("text").alias("texts")).where("sources > 1 and texts > 1")
