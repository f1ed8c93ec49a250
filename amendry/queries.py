"""Registered queries: one per operator and job, over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amendry.functions import dates, money, text
from amendry.operators import change, checks, collect, joins, order
from amendry.operators.asof import asof_lookup
from amendry.operators.lookup import checked_lookup, one_per_key
from amendry.plans import premium, reconcile, samples
from amendry.sources import buckets, ordered, schema, sinks
from amendry.sources.publish import folders, publish, published
from amendry.sources.views import Views
from amendry.sources.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

AS_OF = datetime(2020, 6, 3, 12, 0, 0)
AGE_ON = date(2020, 6, 3)
LOG_DAY = date(2024, 1, 15)
LETTER_DAY = date(1998, 1, 1)
PIVOT = date(1999, 1, 1)  # the test data runs from 1995 to 2001
ROWS, MANY_ROWS, MEMBERS_A_RUN = 1000, 5000, 60
TOP = 200


def query(fn: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    REGISTRY[fn.__name__] = lambda spark, sf_dir: fn(Views(spark, sf_dir))
    return fn


# ---- sources and sinks


@query
def scan_typed(v):
    path = Workspace(v.spark).path("adh1h43pf")
    schema.typed(v.history(), "adh1h43pf").write.parquet(path)
    return schema.to_long(schema.read_table(v.spark, path, "adh1h43pf"), "adh1h43pf")


@query
def scan_full(v):
    return v.source("orders")


@query
def stage_overwrite(v):
    work = Workspace(v.spark)
    work.stage(v.movement(), "movement")
    return work.stage(v.movement().filter("madkmv % 3 = 0"), "movement")


@query
def insert_select(v):
    priority = v.priority().filter("traite = 'N'")
    target = v.spark.createDataFrame([], "idpret bigint, traite string, dateTraite date")
    work = Workspace(v.spark)
    work.append(sinks.insert_select(target, priority), "worklist")
    late = v.loan().filter("prtmot = '2-HIGH'").select(F.col("prtkro").alias("idpret"), F.col("prtdrt").alias("dateTraite"))
    return work.append(sinks.shaped(late, target), "worklist")


@query
def insert_values(v):
    # fixed values: the three loans put on the worklist by hand
    rows = [(4295327, "N"), (4295351, "N"), (4296188, "N")]
    return sinks.insert_values(v.spark, v.priority(), ["idpret", "traite"], rows)


@query
def reject_log(v):
    """What the backfill logged, read back by day from the log it published."""
    root = Workspace(v.spark).path("published")
    publish(v.spark, root, {}, {}, {"log": sinks.dated(_history_job(v).rejects, LOG_DAY)})
    return sinks.read_log(v.spark, root, LOG_DAY)


@query
def log_by_day(v):
    return sinks.log_of_day(v.log(), "logdhe", LOG_DAY)


# ---- projections, filters, predicates


@query
def project_cols(v):
    return v.tier().select("packro", "pacggi", "pactau")


@query
def computed_age(v):
    return v.employee().select("empno", "lastname", dates.age_in_years(F.col("birthdate"), AGE_ON).alias("age"))


@query
def filter_conj(v):
    return v.rate().filter("x_ciecode = 1 and f_idpays = 7 and taxgar = 3")


@query
def worklist_null(v):
    return v.history().filter(F.col("h43tau").isNull()).select("h43ggi", "h43kmv")


@query
def filter_not_null(v):
    return v.history().filter(F.col("h43tau").isNotNull()).select("h43ggi", "h43kmv", "h43tau")


def tiers_of_cover(tier: DataFrame, cover: int, after: date) -> DataFrame:
    return tier.filter((F.col("pacggi") == cover) & F.col("pactau").isNull() & (F.col("pacdep") >= F.lit(after)))


@query
def filter_param(v):
    return tiers_of_cover(v.tier(), 3, date(1998, 1, 1)).select("packro", "pacggi", "pacdep")


@query
def filter_sentinel(v):
    return v.letter().filter(dates.is_open(F.col("cordte"))).select("corkro", "cornat", "cordat")


@query
def filter_zero_rate(v):
    return v.tier().filter(F.col("pactau") == 0).select("packro", "pacggi", "pactau")


@query
def decision_diff(v):
    """Decisions that differ from the OB's latest one in the reference system, NULL counting as 0."""
    source = reconcile.source_latest(v.latest_pointer(), v.source_decision())
    rows = v.decision().withColumn("oba", F.col("gdekro") + 3_000_000)
    looked = checked_lookup(rows, source, [("oba", "decoba"), ("gdegar", "decgar")], ["dectdp"], weight="copies")
    gde, sr = F.coalesce("gdecdc", F.lit(0)), F.coalesce("dectdp", F.lit(0))
    return looked.filter((F.col("status") == "OK") & (gde != sr)).select("gdekro", "gdekrh", "gdegar", "gdecdc", "dectdp")


@query
def filter_blank(v):
    return v.reference().filter(text.is_blank(F.substring("laeref", 13, 11))).select("laekro")


# ---- joins


@query
def join_inner(v):
    return v.movement().join(v.loan(), F.col("madkro") == F.col("prtkro")).select("madkmv", "prtcie", "prtdrt", "prtban")


@query
def join_bucketed(v):
    """Premium rows stored in buckets of their movement, beside the loan of a movement that has one."""
    work = Workspace(v.spark)
    buckets.write_bucketed(v.history().select("h43kmv", "h43nli", "h43ggi"), "h43kmv", 16, work.path("history"))
    loans = one_per_key(v.movement(), ["madkmv"], ["madkro"], "n").filter("n = 1").select("madkmv", "madkro")
    buckets.write_bucketed(loans, "madkmv", 16, work.path("movement"))
    stored, partner = (buckets.read_bucketed(v.spark, work.path(n)) for n in ("history", "movement"))
    return buckets.bucketed_join(stored, partner, "madkmv")


@query
def join_composite(v):
    same = (F.col("cornum") == F.col("prtnum")) & (F.col("corord") == F.col("prtord"))
    return v.letter().join(v.loan(), same).select("corkro", "prtkro", "cordat", "prtres")


@query
def join_threeway(v):
    return samples.premium_context(v.history(), v.movement(), v.loan()).select("prtcie", "prtban", "h43ggi", "prtdrt")


@query
def join_left(v):
    return (
        v.tier().join(v.movement(), F.col("packro") == F.col("madkmv"), "left").select("packro", "pactau", "madkmv")
    )


@query
def join_anti(v):
    return joins.without_match(v.letter(), v.letter_followup(), [("corkro", "csukro")]).select("corkro", "cornat")


@query
def join_semi_exists(v):
    return joins.having_match(v.member(), v.decision(), [("adhkro", "gdekro")])


@query
def join_semi_in(v):
    origin = v.member().filter("adhcor = 4")
    return joins.having_match(v.decision(), origin, [("gdekro", "adhkro")]).select("gdekro", "gdekrh", "gdegar")


@query
def scalar_subquery(v):
    looked = checked_lookup(v.employee(), v.wage().withColumnRenamed("salary", "wage"), [("empno", "empno")], ["wage"])
    return looked.select("empno", "wage", "status")


@query
def lookup_checked(v):
    """Movement of each open history row -> the single loan behind it."""
    todo = v.history().filter(F.col("h43tau").isNull()).select("h43kmv", "h43ggi")
    cols = ["prtcie", "prtban", "prtdrt"]
    loans = premium.movement_loans(v.movement(), one_per_key(v.loan(), ["prtkro"], cols, "loan_n"), cols)
    return checked_lookup(todo, loans, [("h43kmv", "madkmv")], cols, weight="loan_n")


@query
def rate_asof(v):
    """Tax rate in force for each (loan, cover) of the tier table."""
    context = premium.loan_context(v.loan(), v.bank()).filter("loan_n = 1 and bank_n = 1")
    rows = joins.guarded_join(v.tier().select("packro", "pacggi"), context, [("packro", "prtkro")], "inner")
    keys = [("prtcie", "x_ciecode"), ("bqeptx", "f_idpays"), ("pacggi", "taxgar")]
    rated = asof_lookup(rows, v.rate(), keys, "prtdrt", "valid_from", "tau")
    return rated.select("packro", "pacggi", "prtdrt", "tau", "rc")


@query
def worklist_detail(v):
    return premium.worklist_detail(v.tier(), v.priority()).select("pacggi", "packro")


@query
def latest_batch(v):
    return joins.latest_batch_rows(v.decision(), "gdekro", "gdekrh").select("gdekro", "gdekrh", "gdegar", "gdecdc")


# ---- aggregations


@query
def count_all(v):
    return v.history().agg(F.count(F.lit(1)).alias("n"))


@query
def check_exactly_one(v):
    return checks.exactly_one(v.company(), F.col("cieban") == 0, ["ciecie"])


@query
def validate_params(v):
    return reconcile.check_parameters(v.parameters(), v.company())


@query
def group_max(v):
    return joins.group_max(v.decision(), "gdekro", "gdekrh", "derkroDec")


@query
def list_agg_fixed(v):
    """Covers, decisions and batch years of each member as three parallel CHAR(20) lists."""
    items = {
        "covers": "cast(gdegar as string)",
        "decisions": "coalesce(cast(gdecdc as string), '-')",
        "batches": "cast(gdekrh % 10000 as string)",
    }
    return collect.fixed_lists(v.decision(), ["gdekro"], items, order.ascending("gdegar", "gdecdc", "gdekrh"))


@query
def pivot_exclusions(v):
    return reconcile.exclusion_codes(v.exclusion())


@query
def group_flags(v):
    flags = {
        "any_null": "gdecdc is null",
        "any_refused": "gdecdc = 3",
        "any_cover_zero": "gdegar = 0",
    }
    return collect.group_flags(v.decision(), ["gdekro"], flags)


@query
def batch_summary(v):
    return _history_job(v).summary


@query
def updates_per_loan(v):
    return _priority_job(v).per_loan


# ---- sort, limit, top-k


@query
def sort_single(v):
    todo = v.history().filter(F.col("h43tau").isNull()).select("h43ggi", "h43kmv")
    return order.sorted_rows(todo, order.ascending("h43kmv"))


@query
def sort_multi(v):
    return order.sorted_rows(v.tier().select("packro", "pacdep", "pacggi"), order.ascending("packro", "pacdep"))


@query
def sort_desc(v):
    return order.sorted_rows(v.employee().select("empno", "birthdate"), order.descending("birthdate"))


@query
def sort_verified(v):
    """Tiers published in order: rows, first and last key over all files, and files that break the order."""
    by = order.ascending("packro") + order.descending("pacdep") + order.ascending("pacggi")
    path = Workspace(v.spark).path("sorted")
    ordered.write_sorted(v.tier().select("packro", "pacdep", "pacggi"), by, path)
    ranges = Workspace(v.spark).stage(ordered.file_ranges(v.spark, path, by), "ranges")
    broken = ordered.violations(ranges, by).count()
    ends = ranges.agg(F.sum("rows").alias("n"), F.min_by("first", "file").alias("first"), F.max_by("last", "file").alias("last"))
    return ends.select("n", "first.*", *[F.col(f"last.{k.name}").alias(f"last_{k.name}") for k in by], F.lit(broken).cast("long").alias("broken"))


@query
def limit_n(v):
    return _first_open(v, ROWS)


@query
def limit_large(v):
    return _first_open(v, MANY_ROWS)


def _first_open(v, n):
    todo = v.history().filter(F.col("h43tau").isNull()).select("h43kmv", "h43ggi", "h43mpb")
    return order.first_rows(todo, str(n), order.ascending("h43kmv", "h43ggi", "h43mpb"))


@query
def top_k(v):
    return samples.youngest(v.employee(), TOP).select("empno", "lastname", "firstnme", "birthdate")


# ---- table changes


@query
def fill_rate(v):
    """Rates of the tier table filled from the loan's dated rate where NULL."""
    rated = joins.guarded_join(v.tier(), premium.loan_context(v.loan(), v.bank()), [("packro", "prtkro")], "left")
    rated = premium.with_rate(rated, v.rate(), "pacggi")
    filled = change.fill_null(rated, "pactau", F.when(F.col("status") == "OK", F.col("tau")))
    return filled.select("packro", "pacggi", "pacmpa", "pactau")


@query
def update_keyed(v):
    """Every decision row of a member and cover takes the code of a latest source decision."""
    latest = v.source_decision().groupBy("decoba", "decgar").agg(F.max_by("dectdp", "decdec").alias("gdecdc"))
    changes = latest.select((F.col("decoba") - 3_000_000).alias("gdekro"), F.col("decgar").alias("gdegar"), "gdecdc")
    updated = change.update_keyed(v.decision(), changes, ["gdekro", "gdegar"], ["gdecdc"])
    return updated.select("gdekro", "gdekrh", "gdegar", "gdecdc")


@query
def mark_processed(v):
    return change.mark_processed(v.priority(), "traite")


@query
def reset_null(v):
    return change.reset_null(v.history(), "h43tau").select("h43kmv", "h43ggi", "h43tau")


@query
def set_constant(v):
    return change.set_constant(v.priority(), "traite", "N")


@query
def status_update(v):
    """Status of every member from its decisions, including members without any."""
    members = reconcile.list_members(v.member(), v.reference(), v.decision(), with_decision_only=False)
    latest = reconcile.latest_decisions(members, v.decision())
    flags = reconcile.member_flags(
        reconcile.compared_decisions(members, latest, v.decision(), v.latest_pointer(), v.source_decision())
    ).withColumnRenamed("any_wrong", "any_corrected")
    return reconcile.update_status(reconcile.beside(members, flags), reconcile.CORRECT_STEP, AS_OF).select(
        "kronoAdh", "decisionSR", "decisionGDE", "rechercheAno", "correctionAno", "dateModif"
    )


@query
def copy_column(v):
    letters = v.letter().withColumn("corkrg", F.lit(None).cast("bigint"))
    return change.copy_column(letters, "corkro", "corkrg").select("corkro", "cornat", "corkrg")


@query
def update_from_table(v):
    updated = change.update_from_table(v.employee(), v.wage(), [("empno", "empno")], "salary", "salary")
    return updated.select("empno", "lastname", "salary")


@query
def touch_changed(v):
    """A reset stamps only the rows that had a rate."""
    stamped = change.touch_changed(v.tier(), F.col("pactau").isNotNull(), "pacdmo", AS_OF)
    return change.reset_null(stamped, "pactau").select("packro", "pacggi", "pacdmo", "pactau")


@query
def publish_atomic(v):
    """Tiers and worklist published, changed by a job in the partitions it touches, checked together and read back."""
    root = Workspace(v.spark).path("published")
    base = publish(v.spark, root, {"adh1pacpf": v.tier(), "pretprioritaire": v.priority()}, {})
    job = _priority_job(v, Workspace(v.spark))
    sizes = {t: sum(f.rows for f in folders(v.spark, root, t)) for t in ("adh1pacpf", "pretprioritaire")}
    tables = {"adh1pacpf": job.table, "pretprioritaire": job.worklist}
    changed = {"adh1pacpf": job.changed, "pretprioritaire": job.open_loans}
    publish(v.spark, root, tables, {}, changed=changed, rows=sizes, base=base)
    return published(v.spark, root, "adh1pacpf").select("packro", "pacggi", "pactau")


@query
def archive_modified(v):
    """Members corrected in this run, appended to an archive that already holds the BUILDING members."""
    work = Workspace(v.spark)
    held = v.member().filter("adhcor = 1").select(F.col("adhcie").alias("compagnie"), F.col("adhkro").alias("kronoAdh"))
    work.append(sinks.shaped(held, v.spark.createDataFrame([], schema.MEMBERS)), "archive")
    corrected = _correct_job(v).members
    archive = work.append(sinks.archive_rows(corrected), "archive")
    return archive.select("compagnie", "kronoAdh", "garantie", "correctionAno", "dateModif")


@query
def check_pk(v):
    return checks.repeated_keys(v.history(), ["h43nli", "h43kmv"])


@query
def check_fk(v):
    loans = v.loan()
    return checks.orphans(loans, v.bank(), [("prtban", "bqeban")]).select("prtkro", "prtban")


@query
def check_not_null(v):
    required = [f.name for f in schema.struct("adh1pacpf").fields if not f.nullable]
    return checks.null_counts(v.tier(), [*required, "pacmpa", "pactau", "pacmht"])


# ---- scalar functions


@query
def fn_ifnull(v):
    return v.source_decision().select(
        "decdec", F.coalesce("dectdp", F.lit(0)).alias("dectdp"), F.coalesce("decdat", dates.open_date()).alias("decdat")
    )


@query
def fn_substr(v):
    return v.reference().select(
        "laekro", F.substring("laeref", 1, 11).alias("request"), F.substring("laeref", 13, 11).alias("ob")
    )


@query
def fn_try_decimal(v):
    ob = F.substring("laeref", 13, 11)
    return v.reference().select(
        "laekro", text.to_id(ob).alias("ob"), text.to_decimal(F.substring("laeref", 9, 6), 6).alias("malformed")
    )


@query
def fn_date8(v):
    return v.letter().select(
        "corkro", dates.date8(F.col("cordat")).alias("cordat8"), dates.date8_or_zero(F.col("cordte")).alias("cordte8")
    )


@query
def fn_to_date(v):
    parsed = F.to_date(F.date_format("logdhe", "yyyy-MM-dd"))
    return v.log().select("key", F.to_date("logdhe").alias("day"), parsed.alias("parsed"))


def _finer(rate: str, key: str):
    """A rate with non-zero thousandths, which truncation and rounding treat differently."""
    return F.expr(f"cast({rate} + cast(({key} % 1000) / 1000.0 as decimal(5,3)) as decimal(5,3))")


@query
def fn_tax_factor(v):
    return v.history().filter("h43tau is not null").select(
        "h43kmv",
        "h43ggi",
        money.tax_factor(F.col("h43tau")).alias("factor"),
        money.tax_factor(_finer("h43tau", "h43kmv")).alias("fine_factor"),
    )


@query
def split_net_tax(v):
    """Net and tax of every priced tier at the rate of its own row."""
    factor = money.tax_factor(_finer("pactau", "packro"))
    priced = v.tier().filter("pactau is not null and pacmpa is not null")
    net = priced.withColumn("net", money.net_amount(F.col("pacmpa"), factor))
    tax = money.tax_amount(F.col("pacmpa"), F.col("net")).alias("tax")
    return net.select("packro", "pacggi", "pacmpa", "net", tax)


@query
def fn_message(v):
    parts = ("idpret: ", F.col("h43kmv"), " pacggi: ", F.col("h43ggi"), " h43tau: ", F.col("h43tau"), ".")
    profile = text.char_n(F.col("h43pro"), schema.PROFILE_WIDTH)
    return v.history().select("h43kmv", "h43nli", text.message(*parts).alias("line"), profile.alias("profile"))


@query
def fn_case(v):
    ordinal = F.col("excord")
    slot = F.when(ordinal == 1, "gdecn1").when(ordinal == 2, "gdecn2").when(ordinal == 3, "gdecn3").otherwise("ignored")
    return v.exclusion().select("excdec", "excord", slot.alias("slot"))


@query
def rate_rule(v):
    priced = v.tier().join(v.loan(), F.col("packro") == F.col("prtkro"))
    return priced.select(
        "packro", "pacggi", money.rule_rate(F.col("prtdrt"), F.col("pacggi"), PIVOT).alias("rate")
    )


# ---- jobs


def _history_job(v, work=None, limit=order.ALL):
    return premium.backfill_history(v.history(), v.movement(), v.loan(), v.bank(), v.rate(), limit, work)


def _priority_job(v, work=None, only_if_clean=False):
    return premium.backfill_priority(v.tier(), v.priority(), v.loan(), v.bank(), v.rate(), only_if_clean, work)


def _split_job(v, work=None):
    return premium.split_net_tax(v.tier(), v.loan(), v.bank(), v.rate(), work=work)


def _listed(v, work):
    """The listed members and their batch, staged as the next step's input tables."""
    members = work.stage(reconcile.list_members(v.member(), v.reference(), v.decision()), "members")
    return members, work.stage(reconcile.latest_decisions(members, v.decision()), "latest")


def _members(v, work, limit=order.ALL):
    inputs = (*_listed(v, work), v.decision(), v.latest_pointer(), v.source_decision())
    return reconcile.find_anomalies(*inputs, limit=limit, work=work)


def _correct_job(v):
    work = Workspace(v.spark)
    listed, latest = _listed(v, work)
    tables = latest, v.decision(), v.latest_pointer(), v.source_decision()
    searched = work.stage(reconcile.find_anomalies(listed, *tables, work=work).members, "searched")
    return reconcile.correct_anomalies(searched, *tables, v.exclusion(), as_of=AS_OF, work=work)


@query
def job_backfill_history(v):
    return _history_job(v).table.select("h43kmv", "h43nli", "h43ggi", "h43mpb", "h43deb", "h43tau")


@query
def job_backfill_history_limited(v):
    """One run with a quantity; rows that tie at its end are told apart by no column shown."""
    job = _history_job(v, Workspace(v.spark), str(MANY_ROWS))
    return job.table.select("h43kmv", "h43nli", "h43ggi", "h43tau")


@query
def job_backfill_history_rejects(v):
    return _history_job(v).rejects


@query
def job_backfill_priority(v):
    return _priority_job(v).table.select("packro", "pacggi", "pacmpa", "pacdep", "pactau")


@query
def job_backfill_priority_summary(v):
    return _priority_job(v).summary


@query
def job_priority_flags(v):
    return _priority_job(v).worklist


@query
def job_priority_flags_clean(v):
    return _priority_job(v, only_if_clean=True).worklist


@query
def job_split_net_tax(v):
    return _split_job(v).table.select("packro", "pacggi", "pacmpa", "pacmht", "pacmtx", "pacpro")


@query
def job_split_net_tax_rejects(v):
    return _split_job(v).rejects


@query
def job_split_net_tax_end(v):
    return _split_job(v).end


@query
def job_split_net_tax_summary(v):
    return _split_job(v).summary


@query
def job_list_members(v):
    listed = reconcile.list_members(v.member(), v.reference(), v.decision())
    return listed.select("compagnie", "kronoAdh", "numDemSR", "numObaSR")


@query
def job_list_members_single_ob(v):
    listed = reconcile.list_members(v.member(), v.reference(), v.decision(), company=1, exclude_multi_ob=True)
    return listed.select("compagnie", "kronoAdh", "numDemSR", "numObaSR")


@query
def job_latest_decisions(v):
    members = reconcile.list_members(v.member(), v.reference(), v.decision())
    return reconcile.latest_decisions(members, v.decision())


@query
def job_find_anomalies(v):
    return _members(v, Workspace(v.spark)).members.select(
        "kronoAdh", "numObaSR", "garantie", "decisionSR", "decisionGDE", "rechercheAno", "correctionAno"
    )


@query
def job_find_anomalies_limited(v):
    """One run with a quantity: the first members in order are searched, the others are as listed."""
    return _members(v, Workspace(v.spark), str(MEMBERS_A_RUN)).members.select(
        "kronoAdh", "numObaSR", "garantie", "decisionSR", "rechercheAno"
    )


@query
def job_find_anomalies_rejects(v):
    return _members(v, Workspace(v.spark)).rejects


@query
def job_correct_decisions(v):
    return _correct_job(v).decisions.select(
        "gdekro", "gdekrh", "gdegar", "gdedec", "gdecdc", "gdecn1", "gdecn2", "gdecn3"
    )


@query
def job_correct_members(v):
    return _correct_job(v).members.select("kronoAdh", "numObaSR", "garantie", "rechercheAno", "correctionAno", "dateModif")


@query
def job_correct_rejects(v):
    return _correct_job(v).rejects


@query
def job_open_letters(v):
    return samples.open_letters(v.letter(), v.letter_followup(), v.loan(), LETTER_DAY)


@query
def job_sync_salary(v):
    return samples.sync_salary(v.employee(), v.wage(), TOP).select("empno", "lastname", "salary")


@query
def job_premium_report(v):
    return samples.premium_report(v.history(), v.movement(), v.loan())
