"""First-generation views: one wide screen view and the views on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenmart.catalog import Catalog, dataset
from screenmart.functions.text import NEEDS, filled
from screenmart.operators.scope import scope_to_tenant, tenant_from_role
from screenmart.operators.skew import lookup_join
from screenmart.plans.relational import MEMBER_COLUMNS, completed_screens, unpivot_needs

MONEY = "decimal(18,2)"

# Fixed values: (program with a column of its own, whether it counts as a tax credit; None: in neither total).
WIDE_PROGRAMS: list[tuple[str, bool | None]] = [
    ("acp", False),
    ("andcs", False),
    ("awd_medicaid", False),
    ("bca", False),
    ("cccap", False),
    ("cdhcs", False),
    ("cfhc", False),
    ("chp", False),
    ("chs", False),
    ("cocb", False),
    ("coctc", True),
    ("coeitc", True),
    ("co_energy_calculator_bheap", False),
    ("co_energy_calculator_bhgap", False),
    ("co_energy_calculator_care", False),
    ("co_energy_calculator_cngba", False),
    ("co_energy_calculator_cowap", False),
    ("co_energy_calculator_cpcr", False),
    ("co_energy_calculator_ea", False),
    ("co_energy_calculator_energy_ebt", False),
    ("co_energy_calculator_eoc", False),
    ("co_energy_calculator_eoccip", False),
    ("co_energy_calculator_eocs", False),
    ("co_energy_calculator_leap", False),
    ("co_energy_calculator_poipp", False),
    ("co_energy_calculator_ubp", False),
    ("co_energy_calculator_xceleap", False),
    ("co_energy_calculator_xcelgap", False),
    ("co_medicaid", False),
    ("co_snap", False),
    ("co_tanf", False),
    ("co_wic", False),
    ("_dev_ineligible", False),
    ("cowap", False),
    ("cpcr", False),
    ("ctc", False),
    ("cwd_medicaid", False),
    ("dpp", False),
    ("dptr", False),
    ("dsr", False),
    ("dtr", False),
    ("ede", False),
    ("eitc", True),
    ("emergency_medicaid", False),
    ("erap", False),
    ("erc", False),
    ("fatc", True),
    ("fps", False),
    ("leap", False),
    ("lifeline", False),
    ("lwcr", False),
    ("ma_aca", False),
    ("ma_ccdf", False),
    ("ma_cfc", False),
    ("ma_eaedc", False),
    ("ma_maeitc", True),
    ("ma_mass_health", False),
    ("ma_mass_health_limited", False),
    ("ma_mbta", False),
    ("ma_snap", False),
    ("ma_ssp", False),
    ("ma_tafdc", False),
    ("ma_wic", False),
    ("medicaid", False),
    ("medicare_savings", False),
    ("mydenver", False),
    ("myspark", False),
    ("nc_aca", False),
    ("nccip", False),
    ("nc_emergency_medicaid", False),
    ("nc_lieap", False),
    ("nc_medicaid", False),
    ("nc_scca", False),
    ("nc_snap", False),
    ("nc_tanf", False),
    ("ncwap", False),
    ("nc_wic", False),
    ("il_aabd", False),
    ("il_aca", False),
    ("il_aca_adults", False),
    ("il_all_kids", False),
    ("il_bap", False),
    ("il_ctc", True),
    ("il_eitc", True),
    ("il_family_care", False),
    ("il_liheap", False),
    ("il_medicaid", False),
    ("il_moms_and_babies", False),
    ("il_nslp", False),
    ("il_snap", False),
    ("il_tanf", False),
    ("il_transit_reduced_fare", False),
    ("il_wic", False),
    ("nf", False),
    ("nfp", False),
    ("nslp", False),
    ("oap", False),
    ("omnisalud", False),
    ("pell_grant", False),
    ("rag", False),
    ("rhc", False),
    ("rtdlive", False),
    ("shitc", True),
    ("sunbucks", False),
    ("snap", False),
    ("ssdi", False),
    ("ssi", False),
    ("tabor", False),
    ("tanf", False),
    ("trua", False),
    ("ubp", False),
    ("upk", None),
    ("wic", False),
]

# Fixed values: (benefit label, program counted beside it), paired by position as
# published: from "MA TAFDC" on a label stands beside the program before its own, and
# the last program has no label.
BENEFIT_LABELS: list[tuple[str | None, str]] = [
    ("ACP", "acp"),
    ("ANDCS", "andcs"),
    ("AWD Medicaid", "awd_medicaid"),
    ("BCA", "bca"),
    ("CCCAP", "cccap"),
    ("CDHCS", "cdhcs"),
    ("CFHC", "cfhc"),
    ("CHP", "chp"),
    ("CHS", "chs"),
    ("COCB", "cocb"),
    ("COCTC", "coctc"),
    ("COEITC", "coeitc"),
    ("CO Energy Calculator BHEAP", "co_energy_calculator_bheap"),
    ("CO Energy Calculator BHGAP", "co_energy_calculator_bhgap"),
    ("CO Energy Calculator Care", "co_energy_calculator_care"),
    ("CO Energy Calculator CNGBA", "co_energy_calculator_cngba"),
    ("CO Energy Calculator CPCR", "co_energy_calculator_cpcr"),
    ("CO Energy Calculator EA", "co_energy_calculator_ea"),
    ("CO Energy Calculator EBT", "co_energy_calculator_energy_ebt"),
    ("CO Energy Calculator EOC", "co_energy_calculator_eoc"),
    ("CO Energy Calculator EOC CIP", "co_energy_calculator_eoccip"),
    ("CO Energy Calculator EOCS", "co_energy_calculator_eocs"),
    ("CO Energy Calculator LEAP", "co_energy_calculator_leap"),
    ("CO Energy Calculator POIPP", "co_energy_calculator_poipp"),
    ("CO Energy Calculator UBP", "co_energy_calculator_ubp"),
    ("CO Energy Calculator XCELEAP", "co_energy_calculator_xceleap"),
    ("CO Energy Calculator XCELGAP", "co_energy_calculator_xcelgap"),
    ("CO Medicaid", "co_medicaid"),
    ("CO SNAP", "co_snap"),
    ("CO TANF", "co_tanf"),
    ("CO WIC", "co_wic"),
    ("COWAP", "cowap"),
    ("CPCR", "cpcr"),
    ("CTC", "ctc"),
    ("CWD Medicaid", "cwd_medicaid"),
    ("DPP", "dpp"),
    ("DPTR", "dptr"),
    ("DSR", "dsr"),
    ("DTR", "dtr"),
    ("EDE", "ede"),
    ("EITC", "eitc"),
    ("Emergency Medicaid", "emergency_medicaid"),
    ("ERAP", "erap"),
    ("ERC", "erc"),
    ("FATC", "fatc"),
    ("FPS", "fps"),
    ("LEAP", "leap"),
    ("Lifeline", "lifeline"),
    ("LWCR", "lwcr"),
    ("MA ACA", "ma_aca"),
    ("MA CCDF", "ma_ccdf"),
    ("MA CFC", "ma_cfc"),
    ("MA EAEDC", "ma_eaedc"),
    ("MA EITC", "ma_maeitc"),
    ("MA Mass Health", "ma_mass_health"),
    ("MA Mass Health Limited Annual", "ma_mass_health_limited"),
    ("MA MBTA", "ma_mbta"),
    ("MA SNAP", "ma_snap"),
    ("MA SSP", "ma_ssp"),
    ("MA TAFDC", "ma_ssp"),
    ("MA WIC", "ma_tafdc"),
    ("Medicaid", "ma_wic"),
    ("Medicare Savings", "medicaid"),
    ("My Denver", "medicare_savings"),
    ("My Spark", "mydenver"),
    ("NC ACA", "myspark"),
    ("NCCIP", "nc_aca"),
    ("NC Emergency Medicaid", "nccip"),
    ("NC LIEAP", "nc_emergency_medicaid"),
    ("NC Medicaid", "nc_lieap"),
    ("NC SCCA", "nc_medicaid"),
    ("NC SNAP", "nc_scca"),
    ("NC TANF", "nc_snap"),
    ("NC WAP", "nc_tanf"),
    ("NC WIC", "ncwap"),
    ("IL AABD", "nc_wic"),
    ("IL ACA", "il_aabd"),
    ("IL ACA Adults", "il_aca"),
    ("IL All Kids", "il_aca_adults"),
    ("IL BAP", "il_all_kids"),
    ("IL CTC", "il_bap"),
    ("IL EITC", "il_ctc"),
    ("IL Family Care", "il_eitc"),
    ("IL LIHEAP", "il_family_care"),
    ("IL Medicaid", "il_liheap"),
    ("IL Moms and Babies", "il_medicaid"),
    ("IL NSLP", "il_moms_and_babies"),
    ("IL SNAP", "il_nslp"),
    ("IL TANF", "il_snap"),
    ("IL Transit Reduced Fare", "il_tanf"),
    ("IL WIC", "il_transit_reduced_fare"),
    ("NF", "il_wic"),
    ("MFP", "nf"),
    ("NSLP", "nfp"),
    ("OAP", "nslp"),
    ("Omnisalud", "oap"),
    ("Pell Grant", "omnisalud"),
    ("RAG", "pell_grant"),
    ("RHC", "rag"),
    ("RTD Live", "rhc"),
    ("SHITC", "rtdlive"),
    ("Sunbucks", "shitc"),
    ("SNAP", "sunbucks"),
    ("SSDI", "snap"),
    ("SSI", "ssdi"),
    ("Tabor", "ssi"),
    ("TANF", "tabor"),
    ("TRUA", "tanf"),
    ("UBP", "trua"),
    ("WIC", "ubp"),
    (None, "wic"),
]


def _wide_programs(c: Catalog) -> list[tuple[str, bool | None]]:
    return list(c.options.wide_programs or WIDE_PROGRAMS)


def _latest_values(c: Catalog) -> DataFrame:
    """Column per program with its value in the screen's latest snapshot; 0 where not eligible."""
    names = [p for p, _ in _wide_programs(c)]
    latest = c["stg_latest_eligibility_snapshot"]
    eligible = c.source("screener_programeligibilitysnapshot").where("eligible")
    per = eligible.groupBy("eligibility_snapshot_id", "name_abbreviated").agg(F.sum("estimated_value").alias("v"))
    per = per.join(
        latest.select("screen_id", F.col("latest_snapshot_id").alias("eligibility_snapshot_id")),
        "eligibility_snapshot_id",
    )
    wide = per.groupBy("screen_id").pivot("name_abbreviated", names).agg(F.sum("v"))
    return wide.select("screen_id", *[F.coalesce(F.col(p), F.lit(0)).cast(MONEY).alias(f"{p}_annual") for p in names])


def _pair_partners(c: Catalog, screens: DataFrame) -> DataFrame:
    """Partner from the pair of referrer code and referral source.

    The rule runs once per distinct pair and tenant; the pairs then join the
    screens, with frequent pairs (no code at all, usually) spread.
    """
    keys = ["white_label_id", "referrer_code", "referral_source"]
    code, source = F.col("referrer_code"), F.col("referral_source")
    raw = c.source("screener_screen")
    used = raw.where(code != "").select(code.alias("used_code")).distinct().withColumn("used", F.lit(True))
    partners = c.source("programs_referrer").select("white_label_id", "referrer_code", F.col("name").alias("partner"))
    pairs = screens.select(*keys).distinct()

    by_code = partners.withColumnRenamed("partner", "code_partner")
    by_source = partners.withColumnsRenamed({"partner": "source_partner", "referrer_code": "referral_source"})
    pairs = pairs.join(by_code, ["white_label_id", "referrer_code"], "left")
    pairs = pairs.join(by_source, ["white_label_id", "referral_source"], "left")

    def is_used(df: DataFrame, key: Column, out: str) -> DataFrame:
        known = used.select(F.col("used_code").alias(f"_{out}"), F.col("used").alias(out))
        return df.join(known, key == F.col(f"_{out}"), "left").drop(f"_{out}")

    source_key = F.when(filled(code), F.trim(source)).otherwise(source)
    pairs = is_used(is_used(pairs, source_key, "source_used"), F.trim(code), "code_used")
    source_used = F.coalesce("source_used", F.lit(False))
    code_used = F.coalesce("code_used", F.lit(False))
    both = F.concat(
        F.coalesce("code_partner", F.lit("")), F.lit(", "), F.coalesce("source_partner", F.lit(""))
    )
    same = F.trim(source) == F.trim(code)
    with_source = F.when(source_used, F.col("source_partner")).otherwise("Other")
    with_code = (
        F.when(~filled(source), F.col("code_partner"))
        .when(same & source_used, F.col("code_partner"))
        .when(~same & source_used, both)
        .when(~same & code_used, F.col("code_partner"))
        .otherwise("Other")
    )
    no_code = F.when(~filled(source), "No Partner").otherwise(with_source)
    pairs = pairs.select(*keys, F.when(filled(code), with_code).otherwise(no_code).alias("partner"))
    return lookup_join(screens, pairs, keys, "left", null_safe=True)


ENERGY = [
    "is_home_owner", "is_renter", "electric_provider", "electricity_is_disconnected", "has_past_due_energy_bills",
    "has_old_car", "needs_dryer", "needs_hvac", "needs_stove", "needs_water_heater",
]


@dataset("mart", grain=["id"], partition_by=["white_label_id"], sort_by=["submission_date"])
def data(c: Catalog) -> DataFrame:
    """One wide row per finished screen with a value column per program."""
    screens = _pair_partners(c, completed_screens(c)).where(~F.col("partner").eqNullSafe(F.lit("Test")))
    screens = screens.withColumn("screen_id", F.col("id"))
    energy = c.source("screener_energycalculatorscreen").select(
        "screen_id", *ENERGY, F.col("gas_provider").alias("gas_heat_provider")
    )
    for side in (
        c["stg_latest_eligibility_snapshot"],
        _latest_values(c),
        c["stg_monthly_income"],
        c["stg_monthly_expenses"],
        c["stg_household_demographics"],
        energy,
    ):
        screens = screens.join(side, "screen_id", "left")

    def summed(tax: bool) -> Column:
        zero = F.lit(0).cast(MONEY)
        parts = [F.coalesce(F.col(f"{p}_annual"), zero) for p, kind in _wide_programs(c) if kind is tax]
        return sum(parts, zero).cast(MONEY)

    out = screens.drop("screen_id").withColumns(
        {"non_tax_credit_benefits_annual": summed(False), "tax_credits_annual": summed(True)}
    )
    return out.withColumns(
        {
            "non_tax_credit_benefits_monthly": F.col("non_tax_credit_benefits_annual").cast("double") / F.lit(12.0),
            "tax_credits_monthly": F.col("tax_credits_annual").cast("double") / F.lit(12.0),
        }
    )


@dataset("mart")
def data_currentbenefits(c: Catalog) -> DataFrame:
    """Screens with a positive value per tenant, partner and listed benefit."""
    pairs = list(c.options.benefit_labels or BENEFIT_LABELS)
    programs = list(dict.fromkeys(p for _, p in pairs if p is not None))
    counts = c["data"].groupBy("white_label_id", "partner")
    counts = counts.agg(*[F.count_if(F.col(f"{p}_annual") > 0).alias(p) for p in programs])
    rows = [
        F.struct(
            F.lit(label).cast("string").alias("benefit"),
            (F.lit(None) if p is None else F.col(p)).cast("bigint").alias("count"),
        )
        for label, p in pairs
    ]
    return counts.select("white_label_id", "partner", F.inline(F.array(*rows)))


@dataset("mart")
def data_immediate_needs(c: Catalog) -> DataFrame:
    keys = ["white_label_id", "partner"]
    counts = c["data"].groupBy(*keys).agg(*[F.count_if(need).alias(need) for need in NEEDS])
    return unpivot_needs(counts, keys)


def _with_screen(c: Catalog, rows: DataFrame, *columns: str) -> DataFrame:
    screens = c["data"].select(F.col("id").alias("screen_id"), *columns)
    joined = lookup_join(rows, screens, ["screen_id"], "inner")
    return joined.withColumn("screener_id", F.col("screen_id"))


@dataset("mart", grain=["id"])
def data_expenses(c: Catalog) -> DataFrame:
    return _with_screen(c, c.source("screener_expense"), "submission_date", "white_label_id")


@dataset("mart", grain=["id"])
def data_income(c: Catalog) -> DataFrame:
    return _with_screen(c, c.source("screener_incomestream"), "submission_date", "white_label_id")


@dataset("mart", grain=["id"])
def data_householdmembers(c: Catalog) -> DataFrame:
    members = c.source("screener_householdmember").select(*MEMBER_COLUMNS)
    return _with_screen(c, members, "white_label_id", "partner", "submission_date")


@dataset("mart")
def data_programs(c: Catalog) -> DataFrame:
    """English texts of program names and apply links; a label without text stays."""
    label = F.col("label")
    wanted = c.source("translations_translation").where(
        label.ilike("program.%-name") | label.ilike("program.%-apply_button_link")
    )
    texts = c.source("translations_translation_translation").where(F.col("language_code") == "en-us")
    joined = wanted.select(F.col("id").alias("label_id"), "label").join(
        texts, F.col("label_id") == F.col("master_id"), "left"
    )
    return joined.select("id", "master_id", "label", "language_code", "text")


@dataset("mart")
def data_referrer_codes(c: Catalog) -> DataFrame:
    return c.source("programs_referrer").select("referrer_code", F.col("name").alias("partner"), "white_label_id")


def data_tenant(c: Catalog, role: str | None) -> DataFrame:
    """The wide view as one tenant role sees it."""
    return scope_to_tenant(c["data"], tenant_from_role(role))
