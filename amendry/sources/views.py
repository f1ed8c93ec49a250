"""The input tables of the jobs, derived from the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
OB_OFFSET = 3_000_000
REQUEST_OFFSET = 2_000_000


class Views:
    """Each method is one input table over the whole of its source tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def source(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def loan(self) -> DataFrame:
        return self.source("orders").selectExpr(
            "o_orderkey as prtkro",
            "cast(o_custkey % 5 as int) as prtcie",
            "o_custkey as prtban",
            "cast(o_orderdate as date) as prtdrt",
            "o_orderkey div 10 as prtnum",
            "o_orderkey % 10 as prtord",
            "o_orderstatus as prtres",
            "o_orderpriority as prtmot",
        )

    def bank(self) -> DataFrame:
        """Every 40th bank is missing."""
        present = self.source("customer").filter("c_custkey % 40 <> 0")
        return present.selectExpr("c_custkey as bqeban", "c_nationkey as bqeptx")

    def movement(self) -> DataFrame:
        """Some movements are missing, some occur twice."""
        copies = self.source("orders").selectExpr(
            "o_orderkey", "explode(case when o_orderkey % 50 = 1 then array(1, 2) else array(1) end) as copy"
        )
        return copies.filter("o_orderkey % 50 <> 0").selectExpr("o_orderkey * 2 as madkmv", "o_orderkey as madkro")

    def rate(self) -> DataFrame:
        """Three start dates per company, country and cover; cover 7 is missing for some countries."""
        keys = (
            self.source("nation")
            .selectExpr("n_nationkey", "explode(sequence(0, 4)) as cie")
            .selectExpr("*", "explode(sequence(1, 7)) as gar")
            .selectExpr("*", "explode(sequence(1, 3)) as k")
            .filter("not (gar = 7 and n_nationkey % 5 = 0)")
        )
        return keys.selectExpr(
            "cie as x_ciecode",
            "n_nationkey as f_idpays",
            "gar as taxgar",
            "make_date(1994 + 2 * k, 1, 1) as valid_from",
            "cast(((cie * 37 + n_nationkey * 61 + gar * 17 + k * 13) % 160) * 0.125 as decimal(5,3)) as tau",
        )

    def history(self) -> DataFrame:
        return self.source("lineitem").selectExpr(
            "l_shipdate as h43dmo",
            "cast(l_extendedprice as decimal(11,2)) as h43mpb",
            "cast(l_shipdate as date) as h43deb",
            "l_linenumber as h43nli",
            "l_orderkey * 2 as h43kmv",
            "l_linenumber as h43ggi",
            "case when l_returnflag = 'R' then null else cast(l_tax * 100 as decimal(5,3)) end as h43tau",
            "case when l_linestatus = 'O' then null else cast(l_quantity as decimal(11,2)) end as h43mtx",
            "cast(l_extendedprice as decimal(11,2)) as h43mht",
            "l_returnflag as h43pro",
        )

    def tier(self) -> DataFrame:
        """Every 29th order's last covers have no amount."""
        return self.source("lineitem").selectExpr(
            "l_orderkey * 10 + l_linenumber as pacpac",
            "case when l_orderkey % 29 = 0 and l_linenumber >= 5 then null "
            "else cast(l_extendedprice as decimal(11,2)) end as pacmpa",
            "cast(l_shipdate as date) as pacdep",
            "l_shipdate as pacdmo",
            "l_orderkey as packro",
            "l_linenumber as pacggi",
            "case when l_returnflag = 'R' then null else cast(l_tax * 100 as decimal(5,3)) end as pactau",
            "cast(null as decimal(11,2)) as pacmtx",
            "case when l_linestatus = 'O' then null else cast(l_extendedprice as decimal(11,2)) end as pacmht",
            "l_returnflag as pacpro",
        )

    def priority(self) -> DataFrame:
        urgent = self.source("orders").filter("o_orderpriority in ('1-URGENT', '2-HIGH')")
        return urgent.selectExpr(
            "o_orderkey as idpret", "case when o_orderpriority = '1-URGENT' then 'N' else 'O' end as traite"
        )

    def member(self) -> DataFrame:
        return self.source("customer").selectExpr(
            "c_custkey as adhkro",
            "c_nationkey % 3 as adhcie",
            "case when c_mktsegment = 'BUILDING' then 1 else 4 end as adhcor",
        )

    def reference(self) -> DataFrame:
        """External reference text: request number, then the OB number or blanks; some have two.

        Every 13th member has a second reference, to the OB of the next one.
        """
        customer = self.source("customer")
        ob = f"' ' || lpad(cast(c_custkey + {OB_OFFSET} as string), 11, '0')"
        request = f"lpad(cast(c_custkey + {REQUEST_OFFSET} as string), 11, '0')"
        first = customer.selectExpr(
            "c_custkey as laekro",
            f"{request} || case when c_custkey % 33 = 0 then repeat(' ', 12) else {ob} end "
            f"|| case when c_custkey % 47 = 5 then {ob} else '' end as laeref",
        )
        second = customer.filter("c_custkey % 13 = 3").selectExpr(
            "c_custkey as laekro", f"{request} || ' ' || lpad(cast(c_custkey + 1 + {OB_OFFSET} as string), 11, '0') as laeref"
        )
        return first.union(second)

    def decision(self) -> DataFrame:
        """Decisions of the corrected system: ties on the latest batch, some NULL."""
        return self.source("orders").filter("o_custkey % 20 <> 0").selectExpr(
            "o_custkey as gdekro",
            "o_custkey * 10000 + year(o_orderdate) as gdekrh",
            "cast(o_orderkey % 5 as int) as gdegar",
            "case when o_orderkey % 7 = 0 then null else cast(o_orderkey % 4 as int) end as gdecdc",
            "year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) as gdedec",
            "cast(o_orderkey % 3 as int) as gdecn1",
            "0 as gdecn2",
            "0 as gdecn3",
        )

    def _source_decisions(self) -> DataFrame:
        return self.source("orders").filter("o_orderstatus <> 'P' and o_custkey % 25 <> 1")

    def source_decision(self) -> DataFrame:
        """Decisions of the reference system."""
        return self._source_decisions().selectExpr(
            "o_orderkey as decdec",
            f"o_custkey + {OB_OFFSET} as decoba",
            "cast(o_orderkey % 5 as int) as decgar",
            "case when o_orderkey % 11 = 0 then null else cast(o_orderdate as date) end as decdat",
            "case when o_orderkey % 9 = 0 then null else cast(o_orderkey % 4 as int) end as dectdp",
        )

    def latest_pointer(self) -> DataFrame:
        """Latest decision per OB and cover; some pointers occur twice."""
        orders = self._source_decisions().selectExpr(
            "o_orderkey", f"o_custkey + {OB_OFFSET} as ddooba", "o_orderkey % 5 as gar"
        )
        latest = orders.groupBy("ddooba", "gar").max("o_orderkey").withColumnRenamed("max(o_orderkey)", "ddodec")
        copies = latest.selectExpr(
            "ddodec", "ddooba", "explode(case when ddodec % 97 = 0 then array(1, 2) else array(1) end) as copy"
        )
        return copies.drop("copy")

    def exclusion(self) -> DataFrame:
        orders = self.source("orders").selectExpr("o_orderkey as l_orderkey", "o_custkey")
        return self.source("lineitem").join(orders, "l_orderkey").selectExpr(
            "l_orderkey as excdec",
            "cast(l_orderkey % 5 as int) as excgar",
            f"o_custkey + {OB_OFFSET} as excoba",
            "l_linenumber as excord",
            "cast(l_partkey % 100 as int) as exccod",
        )

    def letter(self) -> DataFrame:
        return self.source("orders").selectExpr(
            "o_orderkey as corkro",
            "o_orderkey div 10 as cornum",
            "o_orderkey % 10 as corord",
            "case when o_orderpriority = '1-URGENT' then 250 else 100 end as cornat",
            "case when o_orderstatus = 'O' then date '0001-01-01' else cast(o_orderdate as date) end as cordte",
            "make_date(year(o_orderdate), 1, 1) as cordat",
        )

    def letter_followup(self) -> DataFrame:
        sent = self.source("lineitem").filter("l_returnflag = 'A'")
        return sent.selectExpr("l_orderkey as csukro").distinct()

    def company(self) -> DataFrame:
        """Companies and their banks; some head rows (bank 0) are missing or repeated."""
        return self.source("customer").selectExpr(
            "cast(c_custkey % 700 as int) as ciecie", "cast((c_custkey div 700) % 2 as int) as cieban"
        )

    def parameters(self) -> DataFrame:
        """Run parameters as typed by a caller, some of them invalid."""
        return self.source("customer").selectExpr(
            "c_custkey as prm_id",
            "element_at(array('*lst', '*ano', '*upd', '*del'), cast(c_custkey % 4 as int) + 1) as option",
            "case when c_custkey % 5 = 0 then '    ' when c_custkey % 7 = 0 then 'A12 ' "
            "else cast(c_custkey % 900 as string) end as compagnie",
            "case when c_custkey % 6 = 0 then '' when c_custkey % 11 = 0 then '12x' "
            "else cast(c_custkey as string) end as quantite",
        )

    def employee(self) -> DataFrame:
        """Every 50th birth date is unknown."""
        return self.source("customer").selectExpr(
            "c_custkey as empno",
            "c_name as lastname",
            "c_mktsegment as firstnme",
            "case when c_custkey % 50 = 0 then null "
            "else date_add(date '1960-01-01', cast((c_custkey * 37) % 12000 as int)) end as birthdate",
            "cast(c_acctbal as decimal(11,2)) as salary",
        )

    def wage(self) -> DataFrame:
        """Some employees have two wages."""
        copies = self.source("supplier").selectExpr(
            "s_suppkey as empno",
            "cast(s_acctbal as decimal(11,2)) as salary",
            "explode(case when s_suppkey % 50 = 7 then array(1, 2) else array(1) end) as copy",
        )
        return copies.drop("copy")

    def log(self) -> DataFrame:
        return self.source("events").selectExpr("ts as logdhe", "event_type as code", "event_id as key", "value as rc")
