"""Relations from JSON documents: emitted codes, concept sets and requirements."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carestrata.runtime import broadcast_bounded, materialise

# Parts of a state that test for a code instead of emitting it.
TRANSITION_KEYS = (
    "conditional_transition",
    "complex_transition",
    "direct_transition",
    "distributed_transition",
    "lookup_table_transition",
)

# Criteria that are not judged, labels of a module's origin.
VISIT_CRITERIA = ("VisitOccurrence", "VisitDetail")
CUSTOM_LABEL, BUILT_IN_PREFIX = "custom", "built-in:"

# Levels that are opened between two writes; documents may nest to any depth.
LEVELS_AT_ONCE = 6

_AS_OBJECT = "try_variant_get(node, '$', 'map<string,variant>')"
_AS_ARRAY = "try_variant_get(node, '$', 'array<variant>')"


def _scalar(field: str) -> str:
    """SQL for the text of a field of ``node``, null if it is absent or nested."""
    nested = " or ".join(
        f"try_variant_get(node, '$.{field}', '{kind}') is not null"
        for kind in ("map<string,variant>", "array<variant>")
    )
    text = f"try_variant_get(node, '$.{field}', 'string')"
    return f"case when {text} is not null and not ({nested}) then {text} end"


_IS_CODE = f"({_scalar('system')}) is not null and ({_scalar('code')}) is not null"


def emitted_codes(modules: DataFrame) -> DataFrame:
    """Codes a module can emit, from documents ``(module, document)``.

    A state is searched at any place and depth for objects with a scalar ``system``
    and ``code``; transition blocks are skipped, and so are the states whose type
    ends in ``End``. ``LEVELS_AT_ONCE`` levels are opened in a straight chain, where a
    node either has been recognised and is carried along, or gives way to its
    children; what is recognised is then set aside, and the chain goes on with the
    rest until nothing is left. A row never expands beyond its own document.
    """
    skipped = ", ".join(f"'{k}'" for k in TRANSITION_KEYS)
    states = F.expr("try_variant_get(try_parse_json(document), '$.states', 'map<string,variant>')")
    keep = ["module", "state", "state_type"]
    nodes = (
        modules.select("module", F.explode(F.map_entries(states)).alias("e"))
        .select(
            "module",
            F.col("e.key").alias("state"),
            F.coalesce(F.expr("try_variant_get(e.value, '$.type', 'string')"), F.lit("")).alias("state_type"),
            F.col("e.value").alias("node"),
        )
        .filter(~F.col("state_type").endswith("End"))
        .withColumn("found", F.expr(_IS_CODE))
    )
    children = F.expr(
        f"""case when found then array(node)
            when fields is not null then
                transform(filter(map_entries(fields), x -> x.key not in ({skipped})), x -> x.value)
            else {_AS_ARRAY} end"""
    )
    nested = F.expr(f"not found and ({_AS_OBJECT} is not null or {_AS_ARRAY} is not null)")
    found = []
    while True:
        for _ in range(LEVELS_AT_ONCE):
            nodes = (
                nodes.withColumn("fields", F.expr(f"case when not found then {_AS_OBJECT} end"))
                .select(*keep, "found", F.explode(children).alias("node"))
                .withColumn("found", F.expr(f"found or ({_IS_CODE})"))
            )
        nodes = materialise(nodes.filter(F.col("found") | nested), "module-nodes")
        found.append(nodes.filter("found"))
        nodes = nodes.filter("not found")
        if nodes.isEmpty():
            break
    return (
        reduce(DataFrame.unionByName, found)
        .select(
            *keep,
            F.expr("try_variant_get(node, '$.system', 'string')").alias("system"),
            F.expr("try_variant_get(node, '$.code', 'string')").alias("code"),
            F.coalesce(F.expr("try_variant_get(node, '$.display', 'string')"), F.lit("")).alias("display"),
        )
        .distinct()
    )


def label_modules(custom: DataFrame, built_in: DataFrame) -> DataFrame:
    """Documents ``(path, document)`` of both kinds as ``(module, document)``.

    A built-in document with the base name of a custom one is that same document
    and is left out.
    """
    base = F.element_at(F.split("path", "/"), -1)
    own = custom.withColumn("_base", base)
    names = broadcast_bounded(own.select("_base").distinct(), "module-names")
    others = built_in.withColumn("_base", base).join(names, "_base", "left_anti")
    return own.select(F.lit(CUSTOM_LABEL).alias("module"), "document").unionByName(
        others.select(F.concat(F.lit(BUILT_IN_PREFIX), F.col("path")).alias("module"), "document")
    )


_CRITERION = "map<string, struct<CodesetId: string>>"
_COUNTED = f"array<struct<Criteria: {_CRITERION}, Occurrence: struct<Type: string, Count: string>>>"

# Ids are read as text and cast afterwards: some documents quote them.
_ITEM = (
    "struct<concept: struct<CONCEPT_ID: string>, includeDescendants: boolean, "
    "isExcluded: boolean, includeMapped: boolean>"
)
_DEFINITION = (
    f"ConceptSets array<struct<id: string, expression: struct<items: array<{_ITEM}>>>>, "
    f"PrimaryCriteria struct<CriteriaList: array<{_CRITERION}>>"
)


def document_keys(df: DataFrame) -> list[str]:
    """What names a cohort: its id, within its study where there are several."""
    return [c for c in ("study", "cohort_id") if c in df.columns]


def document_problems(documents: DataFrame) -> DataFrame:
    """Documents ``(cohort_id, problem)`` that are no JSON objects, or whose ids are no numbers."""
    keys = document_keys(documents)
    broken = F.expr("try_variant_get(try_parse_json(document), '$', 'map<string,variant>')").isNull()
    unread = F.expr(
        "exists(flatten(transform(coalesce(d.ConceptSets, array()), s -> coalesce(s.expression.items, array()))),"
        " i -> try_cast(i.concept.CONCEPT_ID as bigint) is null)"
    )
    parsed = documents.select(*keys, broken.alias("_broken"), F.from_json("document", _DEFINITION).alias("d"))
    problem = F.when(F.col("_broken"), "document cannot be read").when(unread, "concept id is no number")
    return parsed.select(*keys, problem.alias("problem")).filter("problem is not null")


def parse_definitions(documents: DataFrame) -> DataFrame:
    """Cohort documents ``(cohort_id, document)`` with the parsed definition ``d``."""
    keys = document_keys(documents)
    return documents.select(*keys, F.from_json("document", _DEFINITION).alias("d"))


def concept_set_items(documents: DataFrame) -> DataFrame:
    """One row per concept set item; a flag that is absent is false."""
    keys = document_keys(documents)
    flag = lambda name: F.coalesce(F.col(f"i.{name}"), F.lit(False))
    return (
        parse_definitions(documents)
        .select(*keys, F.explode("d.ConceptSets").alias("s"))
        .select(*keys, F.col("s.id").try_cast("int").alias("set_id"), F.explode("s.expression.items").alias("i"))
        .select(
            *keys,
            "set_id",
            F.col("i.concept.CONCEPT_ID").try_cast("long").alias("concept_id"),
            flag("includeDescendants").alias("descendants"),
            flag("isExcluded").alias("excluded"),
            flag("includeMapped").alias("mapped"),
        )
    )


def at_least_one(occurrence: str) -> str:
    """SQL for "exactly or at least n events, n at least 1"."""
    return (
        f"(coalesce(try_cast({occurrence}.Type as int), -1) in (0, 2)"
        f" and coalesce(try_cast({occurrence}.Count as int), 0) >= 1)"
    )


_VISITS = ", ".join(f"'{v}'" for v in VISIT_CRITERIA)


def _first_key(criterion: str) -> str:
    return f"map_keys({criterion})[0]"


def _codeset(criterion: str) -> str:
    return f"try_cast(map_values({criterion})[0].CodesetId as int)"


def primary_criteria(documents: DataFrame) -> DataFrame:
    """Per cohort: entry concept sets, and whether its entry can be judged."""
    keys = document_keys(documents)
    return (
        parse_definitions(documents)
        .select(*keys, F.coalesce("d.PrimaryCriteria.CriteriaList", F.array()).alias("all_criteria"))
        .withColumn("judged", F.expr(f"filter(all_criteria, c -> {_first_key('c')} not in ({_VISITS}))"))
        .select(
            *keys,
            F.expr(
                f"array_distinct(filter(transform(judged, c -> {_codeset('c')}), x -> x is not null))"
            ).alias("primary_sets"),
            F.expr(
                f"size(all_criteria) = 0 or exists(judged, c -> {_codeset('c')} is null)"
            ).alias("unevaluable"),
            F.expr("size(judged) < size(all_criteria)").alias("visit_entry"),
        )
    )


def required_sets(documents: DataFrame) -> DataFrame:
    """Requirements ``(cohort_id, requirement, set_id)``; any set of one satisfies it.

    In an ALL group each "at least one" criterion is a requirement of its own
    and the sub-groups are walked. An ANY group is one requirement, but only if
    all its criteria can be judged and it has no sub-groups. Visit criteria and
    criteria without a concept set require nothing.
    """
    keys = document_keys(documents)
    below = "coalesce(try_variant_get(node, '$.Groups', 'array<variant>'), array())"
    itself = "array(named_struct('path', path, 'node', node, 'open', false))"
    opened = F.expr(
        f"""case when open and upper(try_variant_get(node, '$.Type', 'string')) = 'ALL' then
            concat({itself}, transform({below}, (g, i) ->
                named_struct('path', concat(path, array(i)), 'node', g, 'open', true)))
            else {itself} end"""
    )
    rules = F.expr("try_variant_get(try_parse_json(document), '$.InclusionRules', 'array<variant>')")
    rows = (
        documents.select(*keys, F.posexplode(rules).alias("no", "rule"))
        .select(
            *keys,
            F.array("no").alias("path"),
            F.expr("try_variant_get(rule, '$.expression', 'variant')").alias("node"),
            F.lit(True).alias("open"),
        )
    )
    closed = []
    while True:
        for _ in range(LEVELS_AT_ONCE):
            rows = rows.select(*keys, F.explode(opened).alias("x")).select(*keys, "x.*")
        rows = materialise(rows, "inclusion-groups")
        closed.append(rows.filter("not open"))
        rows = rows.filter("open")
        if rows.isEmpty():
            break
    # Groups of one document, level by level; the order is that of the document.
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(F.size("path"), "path")) - 1
    criteria = F.from_json(F.to_json(F.expr("try_variant_get(node, '$.CriteriaList', 'variant')")), _COUNTED)
    groups = reduce(DataFrame.unionByName, closed).select(
        *keys,
        number.alias("group_no"),
        F.struct(
            F.upper(F.expr("try_variant_get(node, '$.Type', 'string')")).alias("type"),
            F.coalesce(criteria, F.array()).alias("criteria"),
            F.expr(f"size({below})").alias("below"),
        ).alias("g"),
    )
    judged = (
        f"case when {at_least_one('c.Occurrence')} and {_first_key('c.Criteria')} not in ({_VISITS}) "
        f"then {_codeset('c.Criteria')} end"
    )
    sets = groups.select(
        *keys, "group_no", "g.type", "g.below", F.expr(f"transform(g.criteria, c -> {judged})").alias("sets")
    )
    each = (
        sets.filter("type = 'ALL'")
        .select(*keys, "group_no", F.posexplode("sets").alias("no", "set_id"))
        .filter("set_id is not null")
    )
    either = (
        sets.filter("type = 'ANY' and below = 0 and size(sets) > 0 and not exists(sets, x -> x is null)")
        .select(*keys, "group_no", F.lit(0).alias("no"), F.explode(F.array_distinct("sets")).alias("set_id"))
    )
    return each.unionByName(either).select(
        *keys, F.concat_ws(".", "group_no", "no").alias("requirement"), "set_id"
    )
