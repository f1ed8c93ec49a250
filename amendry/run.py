"""Run a job on published tables and publish what it changes.

    PYTHONPATH=. spark-submit amendry/run.py backfill_history --root <shared folder> [--quantity 500]

The root holds the published tables under their short names, the log and the manifest.
A run reads the latest version of its inputs, stages its work in the session's shared
folder, and publishes all changed tables, its rejects and its end message, or nothing.
"""

from __future__ import annotations

import argparse
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from amendry.operators.order import ALL
from amendry.plans import premium, reconcile, samples
from amendry.sources.publish import folders, in_parts, latest_version, news, publish, published
from amendry.sources.sinks import archive_rows, dated
from amendry.sources.workspace import Workspace

STEPS = {
    "list_members": reconcile.LIST_STEP,
    "find_anomalies": reconcile.FIND_STEP,
    "correct_anomalies": reconcile.CORRECT_STEP,
}


class InvalidParameter(ValueError):
    """A run was refused because of its parameters."""


class Run:
    """One run: its inputs, options and outputs."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        quantity: int | str = ALL,
        company: int | str | None = None,
        as_of: datetime | None = None,
        day: date | None = None,
    ):
        self.spark, self.root = spark, root
        self.quantity, self.company, self.day = quantity, company, day
        self.as_of = as_of or datetime.now()
        self.work = Workspace(spark)
        self.base = latest_version(spark, root)  # what the run reads, and what no other run may replace meanwhile

    def table(self, name: str) -> DataFrame:
        found = published(self.spark, self.root, name, self.base)
        if found is None:
            raise ValueError(f"no published table {name}")
        return found

    def tables(self, *names: str) -> list[DataFrame]:
        return [self.table(n) for n in names]

    def publish(
        self,
        tables: dict[str, DataFrame],
        sizes: dict[str, int] | None = None,
        log: DataFrame | None = None,
        added: dict[str, DataFrame] | None = None,
        **options: dict,
    ) -> int:
        """Publish tables, log and archive together, provided that the tables have as many rows as they should."""
        added = dict(added or {})
        if log is not None:
            added["log"] = dated(log, self.as_of.date())
        return publish(self.spark, self.root, tables, {}, added, rows=sizes, base=self.base, **options)

    def sizes(self, *names: str) -> dict[str, int]:
        """Updated tables keep their number of rows, which the published version tells."""
        return {name: sum(f.rows for f in folders(self.spark, self.root, name, self.base)) for name in names}

    def finish(self, job: premium.JobResult, tables: dict[str, DataFrame], changed: dict[str, DataFrame]) -> int:
        return self.publish(tables, self.sizes(*tables), job.rejects.unionByName(job.end), changed=changed)

    # ---- premium jobs

    def backfill_history(self) -> int:
        inputs = self.tables("adh1h43pf", "p0amadpf", "t4pprtpf", "p1abqepf", "t4ptaxpf")
        job = premium.backfill_history(*inputs, limit=self.quantity, work=self.work)
        return self.finish(job, {"adh1h43pf": job.table}, {"adh1h43pf": job.changed})

    def backfill_priority(self) -> int:
        inputs = self.tables("adh1pacpf", "pretprioritaire", "t4pprtpf", "p1abqepf", "t4ptaxpf")
        job = premium.backfill_priority(*inputs, work=self.work)
        tables = {"adh1pacpf": job.table, "pretprioritaire": job.worklist}
        return self.finish(job, tables, {"adh1pacpf": job.changed, "pretprioritaire": job.open_loans})

    def split_net_tax(self) -> int:
        inputs = self.tables("adh1pacpf", "t4pprtpf", "p1abqepf", "t4ptaxpf")
        job = premium.split_net_tax(*inputs, work=self.work)
        return self.finish(job, {"adh1pacpf": job.table}, {"adh1pacpf": job.changed})

    # ---- reconciliation, one step per run

    def check_parameters(self, step: str) -> int:
        """The company number of a valid call."""
        company = "" if self.company is None else str(self.company)
        quantity = "99999999" if self.quantity == ALL else str(self.quantity)
        call = (1, STEPS[step], company, quantity)
        params = self.spark.createDataFrame([call], "prm_id int, option string, compagnie string, quantite string")
        wrong = reconcile.check_parameters(params, self.table("t4pciepf")).first()
        if wrong is not None:
            raise InvalidParameter(wrong["message"])
        return int(company)

    def list_members(self) -> int:
        company = self.check_parameters("list_members")
        member, reference, decision = self.tables("t4padhpf", "p0elaepf", "p0egdepf")
        members = self.work.stage(reconcile.list_members(member, reference, decision, company), "members")
        latest, changed = self.latest_batches()
        latest = self.work.stage(latest, "latest")
        tables = {"adhgde2": members, "egdederdec": reconcile.listed_latest(members, latest), "latest_decision": latest}
        listed = members.select("kronoAdh").distinct().count()
        unique = {"egdederdec": ["derkroAdh"], "latest_decision": ["gdekro"]}
        options = {"changed": {"latest_decision": changed}} if changed is not None else {}
        return self.publish(tables, {"egdederdec": listed}, unique=unique, kept_up=["latest_decision"], **options)

    def latest_batches(self) -> tuple[DataFrame, DataFrame | None]:
        """Latest batch of every member, and the members whose batch may have changed since the last listing.

        The batches of the last listing are kept up: only decisions in folders written since are read.
        """
        found = news(self.spark, self.root, "p0egdepf", "latest_decision", self.base)
        known = published(self.spark, self.root, "latest_decision", self.base)
        if found is None or known is None:
            return reconcile.latest_batches(self.table("p0egdepf")), None
        anew = in_parts("latest_decision", found.anew)
        fresh = reconcile.latest_batches(found.rows)
        latest = reconcile.latest_batches(known.filter(~anew).unionByName(fresh))
        return latest, fresh.select("gdekro").union(known.filter(anew).select("gdekro"))

    def find_anomalies(self) -> int:
        self.check_parameters("find_anomalies")
        inputs = self.tables("adhgde2", "egdederdec", "p0egdepf", "sri1ddopf", "p0mdecpf")
        search = reconcile.find_anomalies(*inputs, limit=self.quantity, work=self.work)
        changed = {"adhgde2": search.todo.select("kronoAdh")}
        return self.publish({"adhgde2": search.members}, self.sizes("adhgde2"), search.rejects, changed=changed)

    def correct_anomalies(self) -> int:
        company = self.check_parameters("correct_anomalies")
        inputs = self.tables("adhgde2", "egdederdec", "p0egdepf", "sri1ddopf", "p0mdecpf", "p0mexcpf")
        done = reconcile.correct_anomalies(*inputs, company=company, as_of=self.as_of, work=self.work)
        members = self.work.stage(done.members, "members")
        tables = {"p0egdepf": done.decisions, "adhgde2": members}
        changed = {"p0egdepf": done.merged.filter("not _conflict").select("gdekro"), "adhgde2": done.todo.select("kronoAdh")}
        return self.publish(tables, self.sizes(*tables), done.rejects, {"adhgde2sav": archive_rows(members)}, changed=changed)

    # ---- smaller jobs

    def open_letters(self) -> int:
        if self.day is None:
            raise InvalidParameter("open_letters needs the day of the letters")
        letters = samples.open_letters(*self.tables("t4pcorpf", "adh1csupf", "t4pprtpf"), self.day)
        return self.publish({"open_letters": letters})

    def sync_salary(self) -> int:
        employee, wage = self.tables("employee", "wage")
        chosen = self.work.stage(samples.chosen_wages(employee, wage, self.quantity), "chosen")
        synced = samples.with_salary(employee, chosen)
        return self.publish({"employee": synced}, self.sizes("employee"), changed={"employee": chosen.select("empno")})

    def premium_report(self) -> int:
        lines = samples.premium_report(*self.tables("adh1h43pf", "p0amadpf", "t4pprtpf"))
        return self.publish({"premium_report": lines})


JOBS = [
    "backfill_history",
    "backfill_priority",
    "split_net_tax",
    "list_members",
    "find_anomalies",
    "correct_anomalies",
    "open_letters",
    "sync_salary",
    "premium_report",
]


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run a job on published tables.")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--root", required=True, help="folder of the published tables")
    parser.add_argument("--quantity", default=ALL, help="rows or members to handle, or *all")
    parser.add_argument("--company", help="company number")
    parser.add_argument("--day", type=date.fromisoformat, help="day of the letters")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"amendry {args.job}").getOrCreate()
    run = Run(spark, args.root, args.quantity, args.company, day=args.day)
    version = getattr(run, args.job)()
    print(f"{args.job}: published version {version}")


if __name__ == "__main__":
    main()
