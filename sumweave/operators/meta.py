"""Fixed-effect meta-analysis over aligned variants.

Everything after the alignment shuffle happens inside the row: the studies of a variant are an
array, and a *family* (all studies, all but one, a pair, a named subset) is a set of sums over it,
folded in study order. The families that leave one study out come from two running sums, so their
work is linear in the studies. No further shuffle, and the float order is fixed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sumweave.functions.arrays import bind
from sumweave.functions.numeric import (
    chi2_sf, effective_size, logistic_effective_size, p_from_z, z_from_p,
)

#: Bits used of each word of subset membership.
WORD = 62
RESULT = ["beta", "se", "pval", "n_cases", "n_controls", "n_eff", "af_alt", "info", "het_p"]


@dataclass(frozen=True)
class Method:
    """One weighting scheme, as expressions over a study's row ``m``.

    The p-value is that of |sum(score)| / sqrt(sum(spread)).
    """

    weight: Callable[[Column], Column]
    score: Callable[[Column], Column]
    spread: Callable[[Column], Column]
    has_se: bool
    needs_n: bool


def _inv_var(m: Column) -> Column:
    return F.try_divide(F.lit(1.0), m["se"] * m["se"])


METHODS = {
    "inv_var": Method(weight=_inv_var, score=lambda m: _inv_var(m) * m["beta"], spread=_inv_var,
                      has_se=True, needs_n=True),
    "n": Method(weight=lambda m: F.sqrt(m["neff"]),
                score=lambda m: F.sqrt(m["neff"]) * F.signum(m["beta"]) * m["z"],
                spread=lambda m: m["neff"], has_se=False, needs_n=True),
    "variance": Method(weight=lambda m: F.try_divide(m["z"], m["se"]),
                       score=lambda m: F.try_divide(m["z"], m["se"]) * F.signum(m["beta"]),
                       spread=_inv_var, has_se=False, needs_n=False),
}


def check_methods(methods: Sequence[str], columns: Sequence[str]) -> None:
    for method in methods:
        if method not in METHODS:
            raise ValueError(f"unsupported method {method!r}; known: {', '.join(METHODS)}")
        if method in ("inv_var", "variance"):
            missing = [c for c in ("se", "n") if c not in columns]
            if missing:
                raise ValueError(f"method {method!r} needs column(s) {', '.join(missing)}")


def with_sizes(df: DataFrame, studies: DataFrame) -> DataFrame:
    """Attach n_cases and n_controls of the study dimension, which has one row per study."""
    return df.join(studies.select("study_ord", "n_cases", "n_controls"), "study_ord")


#: Sums every family needs, whatever the method.
COUNTS = ["n", "af", "info", "cases", "controls", "neff", "samples"]
#: What a family of one study passes through.
ONLY = ["beta", "se", "pval", "n_cases", "n_controls", "nlog", "af_alt", "info"]


def _summed(methods: Sequence[str], het: bool) -> list[str]:
    parts = ("w", "wb", "score", "spread", *(("s1", "s2") if het else ()))
    return COUNTS + [f"{part}_{name}" for name in methods for part in parts]


def _origins(members: Column, methods: Sequence[str]) -> Column:
    """Per method a fixed point near the combined effect, from which squares are taken."""
    def origin(name: str) -> Column:
        weight = METHODS[name].weight
        known = F.filter(members, lambda m: weight(m).isNotNull() & m["beta"].isNotNull())
        total = F.aggregate(known, F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("wb")), lambda acc, m: F.struct(
            (acc["w"] + weight(m)).alias("w"), (acc["wb"] + weight(m) * m["beta"]).alias("wb")))
        return bind(total, lambda t: F.coalesce(F.try_divide(t["wb"], t["w"]), F.lit(0.0)))
    return F.struct(*[origin(name).alias(name) for name in methods])


def _terms(members: Column, methods: Sequence[str], het: bool, carried: Sequence[str] = ()) -> Column:
    """Per-study values that every family sums, worked out once per variant."""
    def row(m: Column, origins: Column | None) -> Column:
        n = F.nullif(m["n"], F.lit(0).cast("bigint")).cast("double")
        nlog = logistic_effective_size(m["n_cases"], m["n_controls"])
        values = {"n": n, "af": m["af_alt"] * n, "info": m["info"] * n, "cases": m["n_cases"], "controls": m["n_controls"],
                  "neff": nlog, "samples": m["n"]}
        for name in methods:
            method = METHODS[name]
            weight = method.weight(m)
            values |= {f"w_{name}": weight, f"wb_{name}": weight * m["beta"], f"score_{name}": method.score(m),
                       f"spread_{name}": method.spread(m)}
            if origins is not None:
                off = m["beta"] - origins[name]
                values |= {f"s1_{name}": weight * off, f"s2_{name}": weight * off * off}
        only = F.struct(*[(nlog if c == "nlog" else m[c]).alias(c) for c in ONLY])
        sums = F.struct(*[values[c].cast("double").alias(c) for c in _summed(methods, het)])
        return F.struct(m["study_ord"].alias("study_ord"), m["pval"].alias("pval"), sums.alias("s"), only.alias("only"),
                        *[m[c].alias(c) for c in carried])
    if not het:
        return F.transform(members, lambda m: row(m, None))
    return bind(_origins(members, methods), lambda origins: F.transform(members, lambda m: row(m, origins)))


def _add(a: Column, b: Column, fields: Sequence[str]) -> Column:
    return F.struct(*[(a[f] + b[f]).alias(f) for f in fields])


def _zero(rows: Column, fields: Sequence[str]) -> Column:
    """Zeros that Spark takes for nullable, as the sums that a fold starts from them are."""
    return F.struct(*[F.when(F.size(rows) >= 0, F.lit(0.0)).alias(f) for f in fields])


def _total(rows: Column, fields: Sequence[str]) -> Column:
    """Sums in study order; NULL as soon as one study's value is."""
    return F.aggregate(rows, _zero(rows, fields), lambda acc, m: _add(acc, m["s"], fields))


def _sums_before(rows: Column, fields: Sequence[str]) -> Column:
    """For each row the sums of the rows before it."""
    kind = "array<struct<" + ",".join(f"{f}:double" for f in fields) + ">>"
    start = F.struct(_zero(rows, fields).alias("sum"), F.array().cast(kind).alias("out"))
    return F.aggregate(rows, start, lambda state, m: F.struct(
        _add(state["sum"], m["s"], fields).alias("sum"), F.concat(state["out"], F.array(state["sum"])).alias("out")),
        lambda state: state["out"])


def _left_out(rows: Column, fields: Sequence[str]) -> Column:
    """Map from each study of the variant to the family of all others, in work linear in the studies.

    The others' sums are those before the study plus those after it, so a study without a value
    voids every family but the one that leaves it out. Sums differ from ones taken one by one in the
    last bits only, as nothing is subtracted.
    """
    def entry(both: Column):
        def family(m: Column, i: Column) -> Column:
            sums = _add(F.get(both["before"], i), F.get(both["after"], F.size(rows) - 1 - i), fields)
            return F.struct(m["study_ord"].alias("key"), F.struct(
                (F.size(rows) - 1).alias("n_studies"), sums.alias("s"),
                F.when(F.size(rows) == 2, F.get(rows, 1 - i)["only"]).alias("only")).alias("value"))
        return F.map_from_entries(F.transform(rows, family))

    return bind(F.struct(_sums_before(rows, fields).alias("before"), _sums_before(F.reverse(rows), fields).alias("after")), entry)


def _family(name: Column | str, left_out: Column | None, n_studies: Column, sums: Column, only: Column) -> Column:
    label = F.lit(name) if isinstance(name, str) else name
    out = F.lit(None).cast("int") if left_out is None else left_out
    return F.struct(label.alias("family"), out.alias("left_out"), n_studies.alias("n_studies"), sums.alias("s"), only.alias("only"))


def _families(leave_one_out: bool, leave_most_sig_out: bool, pairwise_with_first: bool,
              subsets: Sequence[str], study_ords: Sequence[int] | Column, everything: bool, fields: Sequence[str]) -> Column:
    rows, whole, others = F.col("_terms"), F.col("_whole"), F.col("_left_out")
    first = F.get(rows, 0)["only"]
    out = [F.array(_family("all", None, F.size(rows), whole, first))] if everything else []
    if leave_most_sig_out:
        # argmin of p, first study on ties; rows without a p-value cannot be the most significant.
        ranked = F.transform(F.filter(rows, lambda m: m["pval"].isNotNull()),
                             lambda m: F.struct(m["pval"], m["study_ord"]))
        drop = F.when(F.size(rows) > 1, F.array_min(ranked)["study_ord"])
        found = lambda o: F.try_element_at(others, o)
        out.append(F.transform(F.array(drop), lambda o: _family(
            "lmso", o, F.coalesce(found(o)["n_studies"], F.lit(0)), found(o)["s"], found(o)["only"])))
    ords = study_ords if isinstance(study_ords, Column) else F.array(*[F.lit(o) for o in study_ords]).cast("array<int>")
    if leave_one_out:
        # Without the study, nothing is left out.
        def leave(o: Column) -> Column:
            all_of_them = F.struct(F.size(rows).alias("n_studies"), whole.alias("s"), first.alias("only"))
            return bind(F.coalesce(F.try_element_at(others, o), all_of_them), lambda f: _family(
                F.concat(F.lit("leave_"), o.cast("string")), o, f["n_studies"], f["s"], f["only"]))
        out.append(F.transform(ords, leave))

    def of_rows(name: Column, inside: Column) -> Column:
        return bind(inside, lambda r: _family(name, None, F.size(r), _total(r, fields), F.get(r, 0)["only"]))

    if pairwise_with_first:
        nothing = F.filter(rows, lambda m: F.lit(False))

        def pair(o: Column) -> Column:
            both = F.filter(rows, lambda m: (m["study_ord"] == F.get(ords, 0)) | (m["study_ord"] == o))
            return of_rows(F.concat(F.lit("pair_"), o.cast("string")), F.when(F.size(both) == 2, both).otherwise(nothing))
        out.append(F.transform(F.slice(ords, F.lit(2), F.greatest(F.size(ords) - 1, F.lit(1))), pair))
    if subsets:
        table = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(i // WORD).alias("word"),
                                   F.lit(1 << i % WORD).cast("bigint").alias("bit"))
                          for i, name in enumerate(subsets)])

        def subset(s: Column) -> Column:
            inside = F.filter(rows, lambda m: F.get(m["subset_bits"], s["word"]).bitwiseAND(s["bit"]) != 0)
            return of_rows(F.concat(F.lit("subset_"), s["name"]), inside)
        # A subset none of whose studies has the variant gives no row.
        out.append(F.filter(F.transform(table, subset), lambda f: f["n_studies"] > 0))
    return F.concat(*out)


def _estimates(name: str, het: bool) -> list[Column]:
    """Effect, z and Cochran's Q of one method, from the family's sums.

    Q is the weighted sum of squares around the combined effect, taken from squares around a fixed
    point: s2 - s1^2 / w, which can't fall below zero but for rounding.
    """
    total = lambda part: F.col(f"_s.{part}_{name}")
    beta = F.try_divide(total("wb"), total("w"))
    z = F.try_divide(total("score"), F.sqrt(total("spread")))
    q = [F.greatest(total("s2") - F.try_divide(total("s1") * total("s1"), total("w")), F.lit(0.0)).alias(f"_q_{name}")] if het else []
    return [beta.alias(f"_beta_{name}"), z.alias(f"_z_{name}"), *q]


def _result(name: str, het: bool) -> Column:
    """The statistics of one family under one method, as a struct."""
    method = METHODS[name]
    none = F.lit(None).cast("double")
    beta, pval = F.col(f"_beta_{name}"), F.col(f"_p_{name}")
    se = F.sqrt(F.try_divide(F.lit(1.0), F.col(f"_s.w_{name}"))) if method.has_se else none
    valid = beta.isNotNull() & pval.isNotNull()
    if method.needs_n:
        valid = valid & F.col("_s.n").isNotNull()
    size = F.col("n_studies")
    only = F.col("_only")
    meta = {
        "beta": beta, "se": se, "pval": pval,
        "n_cases": F.col("_s.cases"), "n_controls": F.col("_s.controls"), "n_eff": F.col("_s.neff"),
        "af_alt": F.try_divide(F.col("_s.af"), F.col("_s.n")), "info": F.try_divide(F.col("_s.info"), F.col("_s.n")),
        "het_p": F.col(f"_het_{name}") if het else none,
    }
    single = {
        "beta": only["beta"], "se": only["se"], "pval": only["pval"], "n_cases": only["n_cases"],
        "n_controls": only["n_controls"], "n_eff": only["nlog"], "af_alt": only["af_alt"],
        "info": only["info"], "het_p": none,
    }
    fields = []
    for field in RESULT:
        value = F.when(size == 1, single[field]).when((size > 1) & valid, meta[field])
        if field.startswith("n_"):
            value = value.cast("bigint")
        fields.append(value.alias(field))
    return F.struct(F.lit(name).alias("method"), *fields)


def meta(aligned: DataFrame, methods: Sequence[str] = ("inv_var",), *, het: bool = False,
         leave_one_out: bool = False, leave_most_sig_out: bool = False,
         pairwise_with_first: bool = False, subsets: Sequence[str] = (), everything: bool = True,
         chrom: int | None = None, study_ords: Sequence[int] | Column = (), keep: Sequence[str] = ()) -> DataFrame:
    """Meta-analyse the result of :func:`align_groups`, in long form.

    ``members`` must carry beta, se, pval, af_alt, info, n, n_cases and n_controls, and
    ``subset_bits`` (see :func:`subset_table`) when ``subsets`` names any. ``study_ords`` is the configured study list,
    which leave-one-out and pairwise results follow even where a study lacks the variant; it may be a
    column, where groups of the table have lists of their own.
    One row per variant, family and method: the grouping columns, the variant, ``occ``, ``family``,
    ``left_out``, ``method``, ``n_studies``, ``n_samples`` and the statistics. A family with two or
    more studies is meta-analysed, one with a single study passes its statistics through, an empty
    one is NULL; so is a result for which some study lacks a needed value.
    """
    member_fields = aligned.schema["members"].dataType.elementType.names
    check_methods(methods, member_fields)
    if chrom is not None:
        aligned = aligned.filter(F.col("chr") == chrom)
    keys = [c for c in aligned.columns if c != "members"]
    needs_z = any(m in ("n", "variance") for m in methods)
    needs_neff = "n" in methods

    def extended(m: Column) -> Column:
        extra = [z_from_p(m["pval"]).alias("z")] if needs_z else []
        if needs_neff:
            extra.append(effective_size(m["n_cases"], m["n_controls"]).alias("neff"))
        return F.struct(*[m[f].alias(f) for f in member_fields], *extra)

    if needs_z or needs_neff:
        aligned = aligned.withColumn("members", F.transform("members", extended))
    fields = _summed(methods, het)
    rows = F.col("_terms")
    terms = aligned.select(*keys, *keep, _terms(F.col("members"), methods, het, ["subset_bits"] if subsets else []).alias("_terms"))
    # One step per layer, so that nothing is worked out twice: sums, families, effects, then tails.
    summed = terms.select("*", _total(rows, fields).alias("_whole"),
                          *([_left_out(rows, fields).alias("_left_out")] if leave_one_out or leave_most_sig_out else []))
    families = _families(leave_one_out, leave_most_sig_out, pairwise_with_first, subsets, study_ords, everything, fields)
    # What is kept of the variant goes with its first family, if there is one of all studies.
    kept = [F.when(F.col("_f.family") == "all", F.col(c)).alias(c) if everything else F.col(c) for c in keep]
    exploded = summed.select(*keys, *keep, F.explode(families).alias("_f")).select(
        *keys, *kept, *[F.col(f"_f.{c}").alias(c) for c in ("family", "left_out", "n_studies")], F.col("_f.s").alias("_s"), F.col("_f.only").alias("_only"))
    estimates = exploded.select("*", F.col("_s.samples").cast("bigint").alias("n_samples"), *[c for name in methods for c in _estimates(name, het)])
    tails = estimates.select(
        "*", *[p_from_z(F.col(f"_z_{name}")).alias(f"_p_{name}") for name in methods],
        *[chi2_sf(F.col(f"_q_{name}"), F.col("n_studies") - 1).alias(f"_het_{name}")
          for name in methods if het])
    results = F.array(*[_result(name, het) for name in methods])
    return tails.select(*keys, *keep, "family", "left_out", "n_studies", "n_samples", F.inline(results))


def subset_bits(rules: dict[str, Column]) -> Column:
    """Which of the rules a study satisfies, one bit per rule.

    Rows carry these few words through the alignment instead of subset names. Pass the names of
    ``rules``, in order, to :func:`meta`.
    """
    conditions = list(rules.values())
    words = []
    for start in range(0, len(conditions), WORD):
        word = F.lit(0).cast("bigint")
        for i, rule in enumerate(conditions[start:start + WORD]):
            word = word + F.when(rule, F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        words.append(word)
    return F.array(*words)


def subset_table(studies: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(study_ord, subset_bits) of every study."""
    return studies.select("study_ord", subset_bits(rules).alias("subset_bits"))


def standard_subsets(name: Column) -> dict[str, Column]:
    """The fixed study subsets: all but some cohorts, ancestries, and combinations of the two."""
    low = F.lower(name)
    # Cohorts that polygenic scores leave out.
    prs = ["hostage", "belcovid", "bosco", "gencovid", "bracovid", "swecovid", "bqc19", "spgrx"]
    not_prs = ~low.rlike("^(" + "|".join(prs) + ")")
    ukbb, genomicc, andme = low.startswith("ukbb"), low.startswith("genomicc"), low.startswith("23andme")
    his = name.endswith("_HIS") | name.endswith("AMR")
    afr = name.endswith("_AFR") & ~name.startswith("Egypt_hgCOVID")
    eas = name.endswith("_EAS") & ~name.startswith("CHULA")
    eur = name.endswith("_EUR") | name.endswith("_FIN")
    return {
        "all": F.lit(True),
        "leave_ukbb": ~ukbb, "leave_genomicc": ~genomicc, "leave_23andme": ~andme,
        "leave_ukbb_23andme": ~ukbb & ~andme, "leave_prs": not_prs,
        "admixed": afr | his, "admixed_leave_23andme": (afr | his) & ~andme,
        "his": his, "his_leave_23andme": his & ~andme,
        "afr": afr, "afr_leave_23andme": afr & ~andme,
        "eas": eas,
        "eur": eur, "eur_leave_23andme": eur & ~andme, "eur_leave_ukbb": eur & ~ukbb,
        "eur_leave_ukbb_23andme": eur & ~ukbb & ~andme,
    }
