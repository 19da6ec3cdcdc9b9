"""Last contact, first treatment and survival endpoints as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def contact_is_latest(contact: Column, lab: Column) -> Column:
    """"Yes" when the last contact is at or after the last lab date (or there is none)."""
    return F.when((contact >= lab) | (contact.isNotNull() & lab.isNull()), F.lit("Yes")).when(
        contact < lab, F.lit("No")
    )


def death_is_latest(death: Column, contact: Column) -> Column:
    """How the death relates to the last contact: Same / Yes / No."""
    return (
        F.when(death == contact, F.lit("Same"))
        .when((death > contact) | (contact.isNotNull() & death.isNull()), F.lit("Yes"))
        .when(death < contact, F.lit("No"))
    )


def reconcile_last_contact(contact: Column, death: Column) -> Column:
    """Last contact, moved back to the death where that came first."""
    return F.when(contact.isNotNull(), F.least(contact, death))


def _strictly_first(x: Column, *others: Column) -> Column:
    tests = [(x < o) | (o.isNull() & x.isNotNull()) for o in others]
    return reduce(lambda a, b: a & b, tests)


def first_modality(radiation: Column, surgery: Column, drug: Column) -> Column:
    """Which treatment came first.

    Ties: a drug start equal to the first radiation counts as drugs, equal to
    the first surgery as surgery; radiation and surgery alone in a tie give null.
    """
    return (
        F.when(_strictly_first(radiation, surgery, drug), F.lit("Radiation"))
        .when(_strictly_first(surgery, radiation, drug), F.lit("Surgery"))
        .when(_strictly_first(drug, radiation, surgery), F.lit("Drugs"))
        .when(drug == radiation, F.lit("Drugs"))
        .when(drug == surgery, F.lit("Surgery"))
    )


def modality_age(first: Column, radiation: Column, surgery: Column, drug: Column) -> Column:
    return (
        F.when(first == "Radiation", radiation)
        .when(first == "Surgery", surgery)
        .when(first == "Drugs", drug)
    )


def survival_endpoints(df: DataFrame) -> DataFrame:
    """Overall, recurrence-free, progression-free and metastasis endpoints.

    Reads vital_status, age_at_death, age_at_last_contact, age_at_diagnosis,
    age_at_first_treatment, pfs_event, pfs_age, had_metastasis,
    has_metastasis_data, age_at_metastatic_site; replaces pfs_event and pfs_age.
    A death counts as progression only where no progression had been observed.
    """
    c = F.col
    death_as_event = (c("rfs_event") == 0) & (c("os_event") == 1)
    out = df.withColumns(
        {
            "os_event": F.when(c("vital_status").isin("Alive", "Lost to follow-up"), 0).when(
                c("vital_status") == "Dead", 1
            ),
            "os_age": F.coalesce("age_at_death", "age_at_last_contact"),
            "rfs_event": c("pfs_event").cast("int"),
            "rfs_age": c("pfs_age"),
            "metastase_event": F.when(c("had_metastasis") == "Yes", 1).when(
                c("has_metastasis_data").isNotNull(), 0
            ),
            "met_age": F.coalesce("age_at_metastatic_site", "age_at_last_contact"),
        }
    )
    out = out.withColumns(
        {
            "pfs_age": F.when(death_as_event, c("os_age")).when(
                c("rfs_event").isin(0, 1), c("rfs_age")
            ),
            "pfs_event": F.when(death_as_event, 1).otherwise(
                F.when(c("rfs_event").isin(0, 1), c("rfs_event"))
            ),
        }
    )
    times = {}
    for name in ("os", "rfs", "pfs", "met"):
        for origin, start in (("dx", "age_at_diagnosis"), ("treatment", "age_at_first_treatment")):
            times[f"{name}_time_from_{origin}_years"] = c(f"{name}_age") - c(start)
    times["time_dx_to_first_treatment_days"] = (
        c("age_at_first_treatment") - c("age_at_diagnosis")
    ) * 365
    return out.withColumns(times)
