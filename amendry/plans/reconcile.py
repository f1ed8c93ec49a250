"""Reconciliation of the decisions held by two systems: list, find differences, correct.

As in a scheduled run, state passes from step to step through the member table, so each
step is a function from tables to tables.
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amendry.functions.dates import clock, date8_or_zero
from amendry.functions.text import is_blank, message, to_decimal, to_id
from amendry.operators import change
from amendry.operators.checks import exactly_one
from amendry.operators.collect import fixed_lists, group_flags, pivot_ordinals
from amendry.operators.joins import group_max, guarded_join, having_match
from amendry.operators.lookup import AMBIGUOUS, NOT_FOUND, OK, checked_lookup
from amendry.operators.order import ALL, ascending, parse_quantity, split_first
from amendry.operators.rejects import RC_AMBIGUOUS, Reason, rejects
from amendry.sources.schema import MEMBERS
from amendry.sources.sinks import shaped
from amendry.sources.workspace import Workspace

# Steps, layout of the reference text, origin code, list width, marks.
LIST_STEP, FIND_STEP, CORRECT_STEP = "*lst", "*ano", "*upd"
REQUEST_AT, OB_AT, ID_WIDTH = 1, 13, 11
SECOND_OB_AT, SECOND_OB_TEXT = 24, " 0"
ORIGIN = 4
LIST_WIDTH = 20
ABSENT, NOT_FOUND_TEXT = "-", "not found"
# The texts are this library's own, and so is the code of a conflict.
DECISION_REASON = Reason("001401", "no single decision for OB {numObaSR}, cover {gdegar}", level="WARN")
CONFLICT = "CONFLICT"
CONFLICT_REASON = Reason(CONFLICT, "the OBs of a member ask for different decisions on cover {gdegar}", level="WARN", rc=RC_AMBIGUOUS)
# Code and text of an invalid parameter.
PARAMETER_CODE, PARAMETER_TEXT = "001227", ("parametre ", " invalide")

# a member row is one member and one of its OBs, which may be unknown
OB_KEY = "coalesce(numObaSR, -1)"

CODES = ["gdecn1", "gdecn2", "gdecn3"]
CHANGED = ["gdedec", "gdecdc", *CODES]
MEMBER_COLUMNS = [column.split()[0] for column in MEMBERS.split(", ")]


def check_parameters(params: DataFrame, company: DataFrame) -> DataFrame:
    """Invalid run parameters, with the first one at fault. One row per call, any number of calls."""
    heads = exactly_one(company, F.col("cieban") == 0, ["ciecie"]).filter("ok").select("ciecie")
    typed = params.withColumn("_cie", to_decimal(F.col("compagnie"), 3).cast("int"))
    known = guarded_join(typed, heads.withColumn("_known", F.lit(True)), [("_cie", "ciecie")], "left")
    option = F.rtrim(F.col("option"))
    quantity_missing = is_blank(F.col("quantite")) | to_decimal(F.col("quantite"), 8).isNull()
    company_wrong = is_blank(F.col("compagnie")) | F.col("_known").isNull()
    fault = (
        F.when(~option.isin(LIST_STEP, FIND_STEP, CORRECT_STEP), "option")
        .when((option == FIND_STEP) & quantity_missing, "quantite")
        .when(company_wrong, "compagnie")
    )
    return (
        known.withColumn("parameter", fault)
        .filter(F.col("parameter").isNotNull())
        .select(
            "prm_id",
            "parameter",
            F.lit(PARAMETER_CODE).alias("code"),
            F.lit("WARN").alias("level"),
            message(PARAMETER_TEXT[0], F.col("parameter"), PARAMETER_TEXT[1]).alias("message"),
        )
    )


def list_members(
    member: DataFrame,
    reference: DataFrame,
    decision: DataFrame,
    company: int | None = None,
    exclude_multi_ob: bool = False,
    with_decision_only: bool = True,
) -> DataFrame:
    """Members of foreign origin that hold decisions, with the request and OB numbers of their reference."""
    chosen = member.filter(F.col("adhcor") == ORIGIN)
    if company is not None:
        chosen = chosen.filter(F.col("adhcie") == company)
    if exclude_multi_ob:
        second = F.substring("laeref", SECOND_OB_AT, len(SECOND_OB_TEXT))
        reference = reference.filter(second != SECOND_OB_TEXT)
    if with_decision_only:
        chosen = having_match(chosen, decision, [("adhkro", "gdekro")])
    listed = chosen.join(reference, F.col("adhkro") == F.col("laekro"), "inner").select(
        F.col("adhcie").alias("compagnie"),
        F.col("adhkro").alias("kronoAdh"),
        to_id(F.substring("laeref", REQUEST_AT, ID_WIDTH)).alias("numDemSR"),
        to_id(F.substring("laeref", OB_AT, ID_WIDTH)).alias("numObaSR"),
    )
    return shaped(listed, member.sparkSession.createDataFrame([], MEMBERS))


def latest_batches(decision: DataFrame) -> DataFrame:
    """Latest decision batch of every member."""
    return group_max(decision, "gdekro", "gdekrh", "gdekrh")


def listed_latest(members: DataFrame, latest: DataFrame) -> DataFrame:
    """The latest batches of the listed members, as the list step stores them."""
    renamed = latest.select(F.col("gdekro").alias("derkroAdh"), F.col("gdekrh").alias("derkroDec"))
    return having_match(renamed, members, [("derkroAdh", "kronoAdh")])


def latest_decisions(members: DataFrame, decision: DataFrame) -> DataFrame:
    """Latest decision batch of each listed member."""
    return listed_latest(members, latest_batches(decision))


def source_latest(pointer: DataFrame, decision: DataFrame) -> DataFrame:
    """Decisions of the reference system that its pointer table names as latest, and how often."""
    merged = pointer.groupBy("ddodec", "ddooba").agg(F.count(F.lit(1)).alias("copies"))
    keys = [("decdec", "ddodec"), ("decoba", "ddooba")]
    return guarded_join(decision, merged, keys, "inner")


def compared_decisions(
    members: DataFrame, latest: DataFrame, decision: DataFrame, pointer: DataFrame, source: DataFrame
) -> DataFrame:
    """The covers of each member's listed batch beside the reference system's decision for that OB and cover.

    `latest` is the batch the list step stored, so a batch that arrives later changes nothing.
    """
    todo = members.select("kronoAdh", "numObaSR").distinct()
    # members meet their batch first, so that decision rows are joined only once
    batch = todo.join(latest, F.col("kronoAdh") == F.col("derkroAdh"), "inner").drop("derkroAdh")
    rows = decision.select("gdekro", "gdekrh", "gdegar", "gdecdc")
    latest = guarded_join(rows, batch, [("gdekro", "kronoAdh"), ("gdekrh", "derkroDec")], "inner")
    cols = ["decdec", "decdat", "dectdp"]
    keys = [("numObaSR", "decoba"), ("gdegar", "decgar")]
    looked = checked_lookup(latest, source_latest(pointer, source), keys, cols, "found", weight="copies")
    looked = looked.selectExpr(
        "gdekro", "numObaSR", f"{OB_KEY} as _ob", "gdegar", "found", "decdec", "decdat",
        "coalesce(gdecdc, 0) as gdecdc",
        f"case when found = '{OK}' then coalesce(dectdp, 0) end as dectdp",
    )
    return looked.withColumn("differs", F.expr(f"found = '{OK}' and gdecdc <> dectdp"))


# covers to list: a difference, or none found there
TO_LIST = f"(differs or found = '{NOT_FOUND}')"
# covers whose decision must change: a difference, or a decision the reference system lacks
TO_CORRECT = f"(differs or (found = '{NOT_FOUND}' and gdecdc <> 0))"


def member_flags(compared: DataFrame) -> DataFrame:
    """Per member and OB: any decision here, any in the reference system, any to list, any to correct."""
    flags = {"gde_found": "true", "sr_found": f"found = '{OK}'", "any_listed": TO_LIST, "any_wrong": TO_CORRECT}
    return group_flags(compared, ["gdekro", "_ob"], flags)


def beside(members: DataFrame, details: DataFrame) -> DataFrame:
    """Members with what is known per member and OB."""
    keyed = members.withColumn("_ob", F.expr(OB_KEY))
    return guarded_join(keyed, details, [("kronoAdh", "gdekro"), ("_ob", "_ob")], "left")


def update_status(members: DataFrame, step: str, as_of: datetime | None = None) -> DataFrame:
    """Four-way member status from the flags beside it; NULL flags mean that no decision was found."""
    no_gde = "not coalesce(gde_found, false)"
    no_sr = f"(not {no_gde} and not sr_found)"
    both = "coalesce(gde_found and sr_found, false)"
    absent = f"'{NOT_FOUND_TEXT}'"
    if step == FIND_STEP:
        anomaly = f"({both} and any_listed)"
        values = {
            "garantie": f"if({anomaly}, _garantie, garantie)",
            "decisionSR": f"case when {no_sr} then {absent} when {anomaly} then _sr else decisionSR end",
            "decisionGDE": f"case when {no_gde} then {absent} when {anomaly} then _gde else decisionGDE end",
            "rechercheAno": f"if({both}, 'O', 'N')",
            "correctionAno": f"if({both} and not any_listed, 'N', correctionAno)",
        }
    else:
        corrected = f"({both} and coalesce(any_corrected, false))"
        members = members.withColumn("_now", clock(as_of))
        values = {
            "decisionSR": f"if({no_sr}, {absent}, decisionSR)",
            "decisionGDE": f"if({no_gde}, {absent}, decisionGDE)",
            "rechercheAno": f"if({both}, rechercheAno, 'N')",
            "correctionAno": f"if({corrected}, 'O', correctionAno)",
            "dateModif": f"if({corrected}, _now, dateModif)",
        }
    return members.selectExpr(*[f"{values.get(c, c)} as {c}" for c in MEMBER_COLUMNS])


class AnomalySearch:
    """Members with lists and status, those searched, and the decisions that were not found, built on first use."""

    def __init__(self, members: DataFrame, compared: DataFrame, todo: DataFrame):
        self.members, self.compared, self.todo = members, compared, todo

    @cached_property
    def rejects(self) -> DataFrame:
        reasons = {NOT_FOUND: DECISION_REASON, AMBIGUOUS: DECISION_REASON}
        return rejects(self.compared, "find_anomalies", "gdekro", reasons, "found")


def find_anomalies(
    members: DataFrame,
    latest: DataFrame,
    decision: DataFrame,
    pointer: DataFrame,
    source: DataFrame,
    limit: int | str = ALL,
    work: Workspace | None = None,
) -> AnomalySearch:
    """Search the members not searched yet."""
    todo = members.filter("rechercheAno is null")
    rest = members.filter("rechercheAno is not null")
    if parse_quantity(limit) is not None:
        work = work or Workspace(members.sparkSession)
        todo, later = split_first(todo, limit, ascending("kronoAdh", "numObaSR"))
        rest = rest.unionByName(later)
    compared = compared_decisions(todo, latest, decision, pointer, source)
    if work is not None:
        compared = work.stage(compared, "compared")
    items = {
        "_garantie": "cast(gdegar as string)",
        "_sr": f"coalesce(cast(dectdp as string), '{ABSENT}')",
        "_gde": "cast(gdecdc as string)",
    }
    order = ascending("gdegar", "dectdp", "gdecdc")
    lists = fixed_lists(compared.filter(TO_LIST), ["gdekro", "_ob"], items, order, LIST_WIDTH)
    details = member_flags(compared).join(lists, ["gdekro", "_ob"], "left")
    searched = update_status(beside(todo, details), FIND_STEP)
    return AnomalySearch(rest.unionByName(searched), compared, todo)


def exclusion_codes(exclusion: DataFrame) -> DataFrame:
    """Exclusions 1 to 3 of each (decision, cover, OB) as three columns."""
    return pivot_ordinals(exclusion, ["excdec", "excgar", "excoba"], "excord", "exccod", CODES)


def decision_changes(compared: DataFrame, exclusion: DataFrame) -> DataFrame:
    """New values per (member, OB, cover): the reference system's decision, or zeros where it has none."""
    keys = [("decdec", "excdec"), ("gdegar", "excgar"), ("numObaSR", "excoba")]
    coded = guarded_join(compared.filter(TO_CORRECT), exclusion_codes(exclusion), keys, "left")
    return coded.select(
        "gdekro",
        "_ob",
        "gdegar",
        date8_or_zero(F.col("decdat")).alias("gdedec"),
        *[F.expr(f"coalesce({c}, 0) as {n}") for c, n in [("dectdp", "gdecdc"), *zip(CODES, CODES)]],
    )


class Correction:
    """The corrected decisions, the members with their status, and what could not be corrected."""

    def __init__(self, decisions: DataFrame, members: DataFrame, compared: DataFrame, merged: DataFrame, todo: DataFrame):
        self.decisions, self.members, self.compared, self.merged, self.todo = decisions, members, compared, merged, todo

    @cached_property
    def rejects(self) -> DataFrame:
        reasons = {NOT_FOUND: DECISION_REASON, AMBIGUOUS: DECISION_REASON}
        missing = rejects(self.compared, "correct_anomalies", "gdekro", reasons, "found")
        conflicts = self.merged.filter("_conflict").select("gdekro", "gdegar", F.lit(CONFLICT).alias("found"))
        return missing.unionByName(rejects(conflicts, "correct_anomalies", "gdekro", {CONFLICT: CONFLICT_REASON}, "found"))


def corrected_flags(changes: DataFrame, merged: DataFrame) -> DataFrame:
    """Per member and OB, whether its decisions were changed, and none of them is in conflict with another OB's."""
    known = merged.select("gdekro", "gdegar", "_conflict")
    asked = guarded_join(changes.select("gdekro", "_ob", "gdegar"), known, [("gdekro", "gdekro"), ("gdegar", "gdegar")], "inner")
    return asked.groupBy("gdekro", "_ob").agg(F.expr("not bool_or(_conflict)").alias("any_corrected"))


def correct_anomalies(
    members: DataFrame,
    latest: DataFrame,
    decision: DataFrame,
    pointer: DataFrame,
    source: DataFrame,
    exclusion: DataFrame,
    company: int | None = None,
    as_of: datetime | None = None,
    work: Workspace | None = None,
) -> Correction:
    """Correct the decisions of members with anomalies.

    A correction applies to every row of the member and cover, not only to the listed batch.
    Where two OBs of a member ask for different decisions on a cover, that cover is left as it
    is and rejected, and the member rows concerned stay open.
    """
    flagged = "garantie is not null and rechercheAno = 'O' and correctionAno is null"
    if company is not None:
        flagged += f" and compagnie = {int(company)}"
    flagged = f"coalesce({flagged}, false)"
    todo, rest = members.filter(flagged), members.filter(f"not {flagged}")
    compared = compared_decisions(todo, latest, decision, pointer, source)
    if work is not None:
        compared = work.stage(compared, "corrected")
    keys, changes = ["gdekro", "gdegar"], decision_changes(compared, exclusion)
    merged = change.merged_changes(changes, keys, CHANGED)
    corrected = change.update_keyed(decision, changes, keys, CHANGED)
    flags = member_flags(compared).join(corrected_flags(changes, merged), ["gdekro", "_ob"], "left")
    done = update_status(beside(todo, flags), CORRECT_STEP, as_of)
    return Correction(corrected, rest.unionByName(done), compared, merged, todo)
