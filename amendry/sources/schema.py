"""Column layouts: short name, long name, type, nullability and label of every column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Layout of the two premium tables (short name, long name, type, required, label).
PREMIUM_HISTORY = [
    ("h43dmo", "C_dateModification", "timestamp_ntz", True, "Date de dernière modification"),
    ("h43mpb", "C_montantPalier_Avant", "decimal(11,2)", True, "Montant TTC du palier avant"),
    ("h43deb", "C_dateEffetPalier_Avant", "date", True, "Date d'effet du palier avant"),
    ("h43nli", "P_numeroLigne", "int", True, "Numéro de ligne"),
    ("h43kmv", "X_idHistoMouvement", "bigint", True, "Krono mouvement -> HistoMvtAdhesion (P0AMADPF)"),
    ("h43ggi", "F_idGarGarantieIncluse", "int", True, "Identifiant -> GarantieDetaillee (PA1XGGIPF)"),
    ("h43tau", "C_taux", "decimal(5,3)", False, "Taux par garantie"),
    ("h43mtx", "C_montantTaxe", "decimal(11,2)", False, "Montant de la taxe"),
    ("h43mht", "C_montantHt", "decimal(11,2)", False, "Montant HT du palier"),
    ("h43pro", "F_profil", "string", False, "Id utilisateur -> UserProfil (T4PUSR52)"),
]
PREMIUM_TIER = [
    ("pacpac", "P_idPalierCotisation", "bigint", True, "Identifiant"),
    ("pacmpa", "C_montantPalier", "decimal(11,2)", False, "Montant TTC du palier"),
    ("pacdep", "C_dateEffetPalier", "date", True, "Date d'effet du palier"),
    ("pacdmo", "C_dateModification", "timestamp_ntz", True, "Date de dernière modification"),
    ("packro", "F_idPret", "bigint", True, "Identifiant -> PretAssure (T4PPRTPF)"),
    ("pacggi", "F_idGarGarantieIncluse", "int", True, "Identifiant -> GarantieDetaillee (PA1XGGIPF)"),
    ("pactau", "C_taux", "decimal(5,3)", False, "Taux par garantie"),
    ("pacmtx", "C_montantTaxe", "decimal(11,2)", False, "Montant de la taxe"),
    ("pacmht", "C_montantHt", "decimal(11,2)", False, "Montant HT du palier"),
    ("pacpro", "F_profil", "string", False, "Id utilisateur -> UserProfil (T4PUSR52)"),
]
LAYOUTS = {"adh1h43pf": PREMIUM_HISTORY, "adh1pacpf": PREMIUM_TIER}

# Long names known for columns of other tables.
LONG_NAMES = {
    "p0amadpf": {"madkmv": "P_idHistoMouvement"},
    "t4pprtpf": {"prtban": "F_banCode", "prtcie": "F_cieCode", "prtdrt": "C_dateReferenceTarifaire"},
    "p1abqepf": {"bqeban": "F_banCode", "bqeptx": "F_idPays_Taxe"},
}

# The member table of the reconciliation.
MEMBERS = (
    "compagnie int, kronoAdh bigint, numDemSR bigint, numObaSR bigint, garantie string, decisionSR string, "
    "decisionGDE string, rechercheAno string, correctionAno string, dateModif timestamp_ntz"
)

# Layouts of all other published tables.
TABLES = {
    "p0amadpf": "madkmv bigint, madkro bigint",
    "t4pprtpf": "prtkro bigint, prtcie int, prtban bigint, prtdrt date, prtnum bigint, prtord bigint, prtres string, "
    "prtmot string",
    "p1abqepf": "bqeban bigint, bqeptx int",
    "t4ptaxpf": "x_ciecode int, f_idpays int, taxgar int, valid_from date, tau decimal(5,3)",
    "pretprioritaire": "idpret bigint, traite string",
    "t4padhpf": "adhkro bigint, adhcie int, adhcor int",
    "p0elaepf": "laekro bigint, laeref string",
    "p0egdepf": "gdekro bigint, gdekrh bigint, gdegar int, gdecdc int, gdedec int, gdecn1 int, gdecn2 int, gdecn3 int",
    "sri1ddopf": "ddodec bigint, ddooba bigint",
    "p0mdecpf": "decdec bigint, decoba bigint, decgar int, decdat date, dectdp int",
    "p0mexcpf": "excdec bigint, excgar int, excoba bigint, excord int, exccod int",
    "t4pciepf": "ciecie int, cieban int",
    "t4pcorpf": "corkro bigint, cornum bigint, corord bigint, cornat int, cordte date, cordat date",
    "adh1csupf": "csukro bigint",
    "employee": "empno bigint, lastname string, firstnme string, birthdate date, salary decimal(11,2)",
    "wage": "empno bigint, salary decimal(11,2)",
    "adhgde2": MEMBERS,
    "adhgde2sav": MEMBERS,
    "latest_decision": "gdekro bigint, gdekrh bigint",
    "egdederdec": "derkroAdh bigint, derkroDec bigint",
    "open_letters": "corkro bigint, cornum bigint, corord bigint, cordat date, prtkro bigint, prtres string, prtmot string",
    "premium_report": "h43kmv bigint, h43nli int, line string",
    "log": "log_date date, step string, code string, kind string, level string, key bigint, message string, rc int",
}

# Published tables that are kept in partitions: by spans of a key, or by a day.
SPAN = 1 << 20
SPANS = {
    "adh1h43pf": ("h43kmv", SPAN),
    "adh1pacpf": ("packro", SPAN),
    "pretprioritaire": ("idpret", SPAN),
    "adhgde2": ("kronoAdh", SPAN),
    "p0egdepf": ("gdekro", SPAN),
    "latest_decision": ("gdekro", SPAN),
    "employee": ("empno", SPAN),
}
DAYS = {"log": "log_date"}

PROFILE_WIDTH = 10  # fixed value: CHAR(10)


def struct(table: str) -> T.StructType:
    """Declared schema under short names, with long names and labels as column metadata."""
    return T.StructType(
        [
            T.StructField(short, T.DataType.fromDDL(kind), not required, {"comment": label, "long_name": long})
            for short, long, kind, required, label in LAYOUTS[table]
        ]
    )


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Read with the declared schema, so that nothing is inferred."""
    return spark.read.schema(struct(table)).parquet(path)


def typed(df: DataFrame, table: str) -> DataFrame:
    """Bring a frame to the declared types, column order and labels of a table."""
    columns = []
    for field in struct(table).fields:
        value = F.col(field.name).cast(field.dataType)
        columns.append(value.alias(field.name, metadata=field.metadata))
    return df.select(*columns)


def struct_of(table: str) -> T.StructType:
    """Declared schema of any published table."""
    return struct(table) if table in LAYOUTS else T.StructType.fromDDL(TABLES[table])


def required(table: str) -> list[str]:
    """Columns that must not be NULL."""
    return [short for short, _, _, needed, _ in LAYOUTS.get(table, []) if needed]


def declared(df: DataFrame, table: str) -> DataFrame:
    """df with the columns and types of the table's layout, if it has one; other columns are refused."""
    if table not in LAYOUTS and table not in TABLES:
        return df
    fields = struct_of(table).fields
    unknown = {c.lower() for c in df.columns} ^ {f.name.lower() for f in fields}
    if unknown:
        raise ValueError(f"{table}: columns missing or not in its layout: {sorted(unknown)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def _names(table: str) -> dict[str, str]:
    return {c[0]: c[1] for c in LAYOUTS[table]} if table in LAYOUTS else LONG_NAMES[table]


def to_long(df: DataFrame, table: str) -> DataFrame:
    return df.withColumnsRenamed({s: l for s, l in _names(table).items() if s in df.columns})


def to_short(df: DataFrame, table: str) -> DataFrame:
    return df.withColumnsRenamed({l: s for s, l in _names(table).items() if l in df.columns})
