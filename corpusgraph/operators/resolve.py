"""Entity resolution: canonical names, types, variant merging and hierarchy.

Input is `mentions(doc_id, name, first_pos)`; every step is a group-by or an
equi-join, so no cluster of variants has to fit in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgraph.functions.defaults import TITLES, TYPE_MARKERS
from corpusgraph.functions.scale import cut, once
from corpusgraph.functions.text import BLANKS, EDGE, WS, last_word, trim_blanks


def canonical_name(name: Column, titles: Sequence[str] = TITLES) -> Column:
    """Drop a possessive ending and one leading title."""
    bare = F.regexp_replace(F.regexp_replace(name, r"(?i)['’]s$", ""), r"['’]$", "")
    bare = trim_blanks(bare)
    untitled = trim_blanks(F.regexp_replace(bare, rf"(?i)^(?:{'|'.join(titles)})\.?{WS}+", ""))
    return F.when(F.length(untitled) >= 2, untitled).otherwise(bare)


def is_judge(raw: Column) -> Column:
    department = rf"(?i)Justice{WS}+(Department|Dept)"
    return raw.rlike(rf"(?i)^Judge{EDGE}") | (raw.rlike(rf"(?i)^Justice{EDGE}") & ~raw.rlike(department))


_PERSON = rf"^[A-Z][a-zA-Z'’.-]+(?:{WS}+[A-Z][a-zA-Z'’.-]+)+$"


def type_by_rules(name: Column, markers: Sequence[tuple[str, str]] = TYPE_MARKERS) -> Column:
    """First matching marker decides, then the person shape, then acronyms; default People."""
    chosen = F
    for kind, words in markers:
        chosen = chosen.when(name.rlike(f"{EDGE}({words}){EDGE}"), kind)
    return chosen.when(name.rlike(_PERSON), "People").when(name.rlike("^[A-Z]{2,}$"), "Organizations").otherwise("People")


def entity_type(
    names: DataFrame, overrides: DataFrame, programs: DataFrame, markers: Sequence[tuple[str, str]] = TYPE_MARKERS
) -> DataFrame:
    """Add `type` to `names(name, judge, …)`; `overrides(name, type)`, `programs(name)` are configuration."""
    fixed = overrides.select("name", F.col("type").alias("_fixed")).dropDuplicates(["name"])
    program = programs.select("name", F.lit(True).alias("_program")).distinct()
    return (
        names.join(fixed, "name", "left")
        .join(program, "name", "left")
        .withColumn(
            "type",
            F.when(F.col("_fixed").isNotNull(), F.col("_fixed"))
            .when(F.col("judge"), "Judges")
            .when(F.col("_program"), "Programs")
            .otherwise(type_by_rules(F.col("name"), markers)),
        )
        .drop("_fixed", "_program")
    )


def canonical_mentions(mentions: DataFrame, titles: Sequence[str] = TITLES) -> DataFrame:
    """doc_id, name, judge, first_pos: one row per document and canonical name."""
    raw = once(mentions.select("doc_id", "name", "first_pos"), judge=is_judge(F.col("name")), _canon=canonical_name(F.col("name"), titles))
    return (
        raw.groupBy("doc_id", F.col("_canon").alias("name"))
        .agg(F.bool_or("judge").alias("judge"), F.min("first_pos").alias("first_pos"))
    )


def group_canonical(canon: DataFrame) -> DataFrame:
    """name, n_docs, judge, first_pos over `canonical_mentions` output."""
    return canon.groupBy("name").agg(
        F.count("*").alias("n_docs"), F.bool_or("judge").alias("judge"), F.min("first_pos").alias("first_pos")
    )


def _ends(persons: DataFrame) -> DataFrame:
    named = persons.filter(F.col("name").rlike(WS))
    first = F.regexp_extract("name", f"^([^{BLANKS}]*)", 1)
    return named.withColumn("first", F.lower(first)).withColumn("last", F.lower(last_word(F.col("name"))))


def persons(typed: DataFrame) -> DataFrame:
    """Names with two or more tokens that are people or judges, with their first and last token."""
    return _ends(typed.filter((F.col("type") == "People") | F.col("judge")))


def merge_first_last(people: DataFrame) -> DataFrame:
    """name, target: same first and last token → the most documented form.

    Ties go to the earliest seen name, then to the smaller one.
    """
    best = people.groupBy("first", "last").agg(
        F.min_by("name", F.struct(-F.col("n_docs"), "first_pos", "name")).alias("target")
    )
    return people.join(best, ["first", "last"]).select("name", "target", "last")


def merge_surnames(typed: DataFrame, merged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Single tokens that are somebody's last token.

    Returns aliases(name, target) where only one person carries the surname,
    and families(name, member) where several do.
    """
    by_last = merged.groupBy("last").agg(
        F.count_distinct("target").alias("n"), F.min("target").alias("target")
    )
    single = typed.filter(~F.col("name").rlike(WS)).select("name", "first_pos", F.lower("name").alias("last"))
    hits = single.join(by_last, "last")
    aliases = hits.filter("n = 1").select("name", "target")
    families = (
        hits.filter("n > 1")
        .select("name", "first_pos", "last")
        .join(merged.select("last", F.col("target").alias("member")).distinct(), "last")
        .select("name", "first_pos", "member")
    )
    return aliases, families


def resolve_alias(merged: DataFrame, aliases: DataFrame) -> DataFrame:
    """name, target for every name that merges into another one."""
    moved = merged.filter("name <> target").select("name", "target")
    return moved.unionByName(aliases.filter("name <> target")).distinct()


def build_entities(
    canon: DataFrame, typed: DataFrame, alias: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """entities(name, type, judge, n_docs, first_pos), doc_entity(doc_id, name), entity_aliases(name, alias)."""
    target = F.coalesce("target", "name")
    doc_entity = canon.join(alias, "name", "left").select("doc_id", target.alias("name")).distinct()
    n_docs = doc_entity.groupBy("name").agg(F.count("*").alias("n_docs"))
    entities = typed.select("name", "type", "judge", "first_pos").join(n_docs, "name")
    return entities, doc_entity, alias.select(F.col("target").alias("name"), F.col("name").alias("alias"))


_COUNTY = rf"(?i)^(.*{EDGE}County){EDGE}.+(District Attorney|Sheriff|Court)"


def attach_parents(
    entities: DataFrame,
    containment: DataFrame,
    families: DataFrame,
    overrides: DataFrame,
    programs: DataFrame,
    markers: Sequence[tuple[str, str]] = TYPE_MARKERS,
) -> DataFrame:
    """name, type, parent, n_docs.

    Parents come from the curated `containment(child, parent)`, then families,
    then "X County …" offices; a later rule replaces an earlier one. Curated
    parents missing from the corpus are created; curated parents become
    Programs unless they are People.
    """
    curated = containment.join(entities.select(F.col("name").alias("child")), "child", "left_semi")
    curated = curated.groupBy("child").agg(F.max("parent").alias("parent"))
    parents = curated.select(F.col("parent").alias("name")).distinct()
    known = entities.select("name", "type", "n_docs", F.lit(False).alias("judge"))
    created = entity_type(
        parents.join(known, "name", "left_anti").withColumn("judge", F.lit(False)), overrides, programs, markers
    ).withColumn("n_docs", F.lit(0).cast("long"))
    everyone = known.unionByName(created)

    family = families.groupBy(F.col("member").alias("name")).agg(
        F.max_by("name", F.struct("first_pos", "name")).alias("_family")
    )
    hubs = families.select("name", F.lit(True).alias("_hub")).distinct()
    office = everyone.select("name", F.regexp_extract("name", _COUNTY, 1).alias("_county")).filter("_county <> ''")
    county = office.join(everyone.select(F.col("name").alias("_county")), "_county", "left_semi")
    county = county.filter("_county <> name")

    out = (
        everyone.join(curated.withColumnRenamed("child", "name").withColumnRenamed("parent", "_curated"), "name", "left")
        .join(family, "name", "left")
        .join(hubs, "name", "left")
        .join(county, "name", "left")
        .join(parents.withColumn("_is_parent", F.lit(True)), "name", "left")
    )
    kind = (
        F.when(F.col("_hub"), "Families")
        .when(F.col("_is_parent") & (F.col("type") != "People"), "Programs")
        .otherwise(F.col("type"))
    )
    curated_ok = F.when(F.col("_curated") != F.col("name"), F.col("_curated"))
    family_ok = F.when(F.col("_family") != F.col("name"), F.col("_family"))
    return out.select(
        "name", kind.alias("type"), F.coalesce("_county", family_ok, curated_ok).alias("parent"), "n_docs"
    )


def children(hierarchy: DataFrame) -> DataFrame:
    """parent, child, sorted within the parent."""
    return hierarchy.filter("parent IS NOT NULL").select("parent", F.col("name").alias("child"))


def resolve(
    mentions: DataFrame,
    overrides: DataFrame,
    programs: DataFrame,
    containment: DataFrame,
    titles: Sequence[str] = TITLES,
    markers: Sequence[tuple[str, str]] = TYPE_MARKERS,
) -> dict[str, DataFrame]:
    """Every table of the chain: canonical, typed, merged and linked entities.

    Tables that several later steps read are written once instead of being
    derived from the text again.
    """
    canon = cut(canonical_mentions(mentions, titles))
    typed = cut(entity_type(group_canonical(canon), overrides, programs, markers))
    merged = cut(merge_first_last(persons(typed)))
    aliases, families = merge_surnames(typed, merged)
    alias = cut(resolve_alias(merged, aliases))
    entities, doc_entity, entity_aliases = build_entities(canon, typed, alias)
    return {
        "canon": canon,
        "typed": typed,
        "merged": merged,
        "surnames": aliases,
        "families": families,
        "alias": alias,
        "entities": attach_parents(entities, containment, families, overrides, programs, markers),
        "doc_entity": doc_entity,
        "aliases": entity_aliases,
    }
