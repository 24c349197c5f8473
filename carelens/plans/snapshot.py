"""Characterization of the enrolled population and its use of care."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from carelens.operators import linkage, spans, summary
from carelens.sources.tables import Tables, table


def without(tables: Tables, patients: DataFrame | None, encounters: DataFrame | None) -> Tables:
    """Tables less the listed patients and the listed (patient, encounter) pairs."""
    out = dict(tables)
    if patients is not None:
        ids = {"enr": ["patid"], "mil": ["mpatid", "cpatid"]}
        for name, columns in ids.items():
            for c in columns if name in out else []:
                out[name] = spans.exclude(out[name], patients, {c: "patid"})
    if encounters is not None and "enc" in out:
        on = {"patid": "patid", "encounterid": "encounterid"}
        out["enc"] = spans.exclude(out["enc"], encounters, on)
    return out


def periods(tables: Tables) -> Tables:
    """Bridged periods of all coverage types; written once, every summary reads them."""
    return {"enr_final_mstr": spans.bridge(spans.by_coverage(table(tables, "enr")), ["cov", "patid"])}


def summaries(t: Tables, periods: DataFrame, maxdate: Column, zips: DataFrame | None = None) -> Tables:
    """Every summary the given tables allow; only `dem` is required."""
    md = periods.where("cov = 'md'").drop("cov")
    enrolled = spans.enrolled(periods, ["cov", "patid"])
    dem = summary.enrolled_rows(
        table(t, "dem"), enrolled.where("cov = 'md'"), ["hispanic", "race", "sex", "postalcode"]
    )
    out = {
        "enr_patid_count_md_y": summary.periods_by_year(md),
        "enr_rec_covlength_md": summary.length_by_record(md),
        "enr_pat_covlength_md": summary.length_by_patient(md),
        "enr_patid_ct_md": summary.patient_totals(md, maxdate),
        "enr_pat_enrcount_md": summary.periods_per_patient(md),
        "dem_pat_agecount_md": summary.age_categories(summary.age_profile(md, table(t, "dem"), maxdate)),
        "dem_categories_md": summary.category_counts(dem, ["hispanic", "race", "sex"]),
    }
    if zips is not None:
        out["dem_geolocct_md"] = summary.geography(dem, zips)
    if "dis" in t:
        out["dis_pat_rxcount"] = summary.records_in_enrollment(t["dis"], periods, "rxdate", ["d", "md"])
    if "enc" in t:
        out["enc_pat_enccount"] = summary.records_in_enrollment(t["enc"], periods, "adate", ["md"])
    if "lab" in t:
        out["lab_pat_testcount"] = summary.records_in_enrollment(
            summary.lab_dates(t["lab"]), periods, "testdate", ["md"]
        )
    if "vit" in t:
        out["vit_pat_vitct_md"] = summary.vitals_in_enrollment(t["vit"], md)
    if "dth" in t:
        out["dth_dthct"] = summary.records_of_enrolled(t["dth"], enrolled, ["m", "md"])
    if "cod" in t:
        out["cod_pat_codct"] = summary.causes_per_patient(
            t["cod"], enrolled.where("cov in ('m', 'md')")
        )
    if "mil" in t:
        out["mil_linkage_rates"] = linkage.linkage_rates(linkage.deliveries(t["mil"])).drop("tablesort")
    return out
