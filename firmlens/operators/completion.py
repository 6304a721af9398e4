"""What fills a row from its other columns: fallback texts, phone columns, reports made again, partner texts, golden sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlens.functions import fixed, phones, urls
from firmlens.functions.text import blank_to_null, clean_text, contains_any, fenced_json, first_usable, squeeze

# ---------------------------------------------------------------- columns by name


def pick_column(names: Sequence[str], *wanted: str) -> str | None:
    """The first of the wanted names that a table has, in any case."""
    by_case = {n.lower().strip(): n for n in names}
    return next((by_case[w.lower()] for w in wanted if w.lower() in by_case), None)


def column_or_blank(df: DataFrame, *wanted: str) -> Column:
    """The text of the first column of these names that isn't blank, '' if there is none."""
    by_case = {n.lower().strip(): n for n in df.columns}
    found = [F.col(f"`{by_case[w.lower()]}`").cast("string") for w in wanted if w.lower() in by_case]
    return F.coalesce(first_usable(*found, blanks=("nan", "none", "null")), F.lit("")) if found else F.lit("")


def is_retrieved_column(name: str | None) -> bool:
    """Whether a phone column holds numbers that were found, not given."""
    return (name or "").strip().lower() in fixed.RETRIEVED_COLUMNS


# ---------------------------------------------------------------- texts

def context_blob(df: DataFrame) -> Column:
    """Description, keywords and reasoning of an input row as one text with headings; blank ones left out."""
    parts = (("Short description", ("Short Description", "Description", "Combined_Description")), ("Keywords", ("Keywords",)), ("Reasoning", ("reasoning",)))
    said = [F.concat(F.lit(f"{head}:\n"), F.nullif(column_or_blank(df, *names), F.lit(""))) for head, names in parts]
    return F.concat_ws("\n\n", *said)


def fallback_text(df: DataFrame, scraped: str, status: str, *, synthesize: bool = False, care_profile: bool = False) -> DataFrame:
    """df with `text`, `text_status`: the scraped text, else a description column, else categories and products, else (if
    synthesize) a line of name, site and industry. Rows without any have a null text and LLM_Input_NoTextAvailable.
    care_profile: contacts and the first 4000 characters of the PDF text come before the descriptions."""
    own = blank_to_null(F.col(scraped))
    care = F.nullif(F.concat_ws("\n\n", F.nullif(column_or_blank(df, "contacts"), F.lit("")), F.nullif(F.left(column_or_blank(df, "pdf_text"), F.lit(4000)), F.lit(""))), F.lit("")) if care_profile else F.lit(None).cast("string")
    described = F.nullif(column_or_blank(df, *fixed.FALLBACK_COLUMNS), F.lit(""))
    combined = F.nullif(F.concat_ws("\n\n", *[F.nullif(column_or_blank(df, c), F.lit("")) for c in ("categories", "products")]), F.lit(""))
    industry = F.nullif(column_or_blank(df, "Industry", "Kategorie", "category"), F.lit(""))
    line = F.concat(column_or_blank(df, "CompanyName"), F.lit(" — Website: "), column_or_blank(df, "GivenURL"), F.lit("."), F.coalesce(F.concat(F.lit(" Industry: "), industry, F.lit(".")), F.lit("")))
    other = F.coalesce(care, described, combined)
    return df.withColumns({
        "text": F.coalesce(own, other, line if synthesize else F.lit(None).cast("string")),
        "text_status": F.when(own.isNotNull(), F.col(status)).when(other.isNotNull(), "Used_Fallback_Description").otherwise(F.col(status) if synthesize else F.lit("LLM_Input_NoTextAvailable"))})


def html_usable(text: Column, least: int = 200, blocked: Sequence[str] = fixed.BLOCK_WORDS) -> Column:
    """Why a page's text can't stand for a site, or `usable`."""
    low = F.lower(F.coalesce(text, F.lit("")))
    out = F.when(F.trim(low) == "", "empty_html").when(F.length(low) < least, F.concat(F.lit("rejected_too_short:"), F.length(low).cast("string"), F.lit(f"<{least}")))
    for word in blocked:
        out = out.when(F.contains(low, F.lit(word)), f"rejected_block_keyword:{word}")
    return out.otherwise("usable")


# ---------------------------------------------------------------- phone columns

def phone_columns(df: DataFrame, given: str = "PhoneNumber", *, retrieve: bool = True) -> DataFrame:
    """df(given, primary, secondary: best numbers found; top_number, top_type, top_source) with found_number,
    phone_status, top_number, top_type, primary_number, input_phone_number, retrieved_phone_number and has_phone.

    A usable given number stands as it is; else the first primary, then secondary number found; else, where none is found,
    none. A fax as top number is never the number to call.
    """
    number = phones.strip_excel(F.col(given))
    usable = ~phones.needs_retrieval(F.col(given))
    primary, secondary = blank_to_null(F.col("primary")), blank_to_null(F.col("secondary"))
    status = F.when(usable, "Provided_In_Input")
    if retrieve:
        status = status.when(primary.isNotNull(), "Found_Primary").when(secondary.isNotNull(), "Found_Secondary").otherwise("No_Main_Line_Found")
    else:
        status = status.otherwise("Skipped_Phone_Retrieval")
    callable_top = F.when(~phones.is_fax(F.col("top_type")), blank_to_null(F.col("top_number")))
    best = F.coalesce(primary, secondary)
    out = df.withColumn("phone_status", status)
    found = F.when(usable, number).when(F.lit(retrieve) & best.isNotNull(), F.coalesce(callable_top, best))
    fax = phones.is_fax(F.col("top_type")) & found.eqNullSafe(blank_to_null(F.col("top_number")))
    found = F.when(~F.coalesce(fax, F.lit(False)), found)
    out = out.withColumn("found_number", found)
    source = F.when(F.col("phone_status") == "Provided_In_Input", "Provided_In_Input").when(best.isNotNull() & F.lit(retrieve), "Retrieved")
    top = F.coalesce(blank_to_null(F.col("top_number")), F.when(usable, number), best if retrieve else F.lit(None).cast("string"))
    retrieved = F.when(F.col("phone_status").isin("Found_Primary", "Found_Secondary"), F.coalesce(callable_top, F.col("found_number")))
    return out.withColumns({
        "top_number": top, "top_type": F.coalesce(blank_to_null(F.col("top_type")), F.when(top.isNotNull(), source)), "primary_number": F.when(usable, number).otherwise(primary),
        "input_phone_number": number, "retrieved_phone_number": retrieved, "has_phone": F.col("found_number").isNotNull()})


def reported_number(status: Column, found: Column, given: Column, region: str = "DE") -> Column:
    """The number a report made again shows for a status, normalized; '' if none."""
    chosen = F.when(status.isin("Found_Primary", "Found_Secondary", "Fallback_To_Input"), found).when(status == "Provided_In_Input", given)
    return F.coalesce(phones.e164(chosen, region), F.lit(""))


def report_again(live: DataFrame, renames: dict[str, str], columns: Sequence[str], region: str = "DE") -> DataFrame:
    """A sales report from a live table: rows without a usable number go, columns are renamed, missing ones are ''."""
    kept = live.where(~F.coalesce(F.col("PhoneNumber_Status").isin("No_Candidates_Found", "No_Main_Line_Found"), F.lit(False)))
    kept = kept.withColumn("found_number", reported_number(F.col("PhoneNumber_Status"), F.col("found_number"), F.col("PhoneNumber"), region)).withColumnsRenamed(renames)
    return kept.select(*[F.col(f"`{c}`") if c in kept.columns else F.lit("").alias(c) for c in columns])


def processed_contacts(contacts: DataFrame) -> DataFrame:
    """The last contact list: company name (of the summary, else of the address where there is a description), number and
    type split. contacts: CompanyNameSummary, SummaryDescription, CanonicalEntryURL, Industry, PhoneNumber_1, SourceURL_1."""
    name, said = blank_to_null(F.col("CompanyNameSummary")), blank_to_null(F.col("SummaryDescription"))
    split = phones.split_number_type(F.col("PhoneNumber_1"))
    return contacts.select(
        F.coalesce(name, F.when(said.isNotNull(), urls.label(F.col("CanonicalEntryURL")))).alias("company"), F.col("CanonicalEntryURL").alias("url"), split["number"].alias("number"),
        split["type"].alias("number_type"), F.col("Industry").alias("industry"), said.alias("description"), F.col("SourceURL_1").alias("found_at"))


# ---------------------------------------------------------------- artifacts

def artifact_rows(artifacts: DataFrame) -> DataFrame:
    """artifacts(path, text) of one answer each to a row for each row number in the file names (Row12_…): sales_pitch,
    matched_partner, match_reasoning, complete. The last file by name wins; files without JSON or row number go."""
    a = artifacts.withColumn("row_index", F.regexp_extract("path", r"Row(\d+)_[^/]*$", 1).try_cast("long")).where("row_index IS NOT NULL")
    kind = "phone_sales_line string, matched_partner_name string, match_rationale_features array<string>, matched_partner_description string"
    a = a.withColumn("j", F.from_json(fenced_json(F.col("text")), kind)).where("j IS NOT NULL")
    last = lambda c, when: F.max_by(F.when(when, c), F.when(when, F.col("path")))
    named = F.col("j.matched_partner_name").isNotNull()
    out = a.groupBy("row_index").agg(
        last(F.col("j.phone_sales_line"), F.col("j.phone_sales_line").isNotNull()).alias("sales_pitch"), last(F.col("j.matched_partner_name"), named).alias("matched_partner"),
        last(F.array_join(F.coalesce("j.match_rationale_features", F.array().cast("array<string>")), "; "), named).alias("match_reasoning"))
    return out.withColumn("complete", F.col("sales_pitch").isNotNull() & F.col("matched_partner").isNotNull())


# ---------------------------------------------------------------- partners

def partner_summary(partner: dict[str, Column], fields: Sequence[tuple[str, str]] = fixed.SUMMARY_FIELDS) -> Column:
    """`Industry: …; USP: …` of a partner's columns; blanks and n/a left out; a note if nothing is left."""
    parts = [F.concat(F.lit(f"{label}: "), blank_to_null(partner[key], ("n/a",))) for key, label in fields if key in partner]
    return F.coalesce(F.nullif(F.concat_ws("; ", *parts), F.lit("")), F.lit("Partner data not available or insufficient for summary."))


def partner_aliases(name: Column, host: Column) -> Column:
    """Name, name without its legal form, web host and the host's first label; each once in any case, blanks left out."""
    plain = F.regexp_replace(F.regexp_replace(name, r"(?i)\b(gmbh|ug|inc|llc|ag|kg|ltd|mbh)\b", ""), r"^[ ,.\-]+|[ ,.\-]+$", "")
    ways = F.filter(F.transform(F.array(name, plain, host, F.substring_index(host, ".", 1)), lambda x: clean_text(x)), lambda x: F.coalesce(x, F.lit("")) != "")
    seen = F.transform(ways, lambda x: F.lower(x))
    return F.filter(ways, lambda x, i: F.array_position(seen, F.lower(x)) == i + 1)


def prompt_payload(partner: dict[str, Column]) -> Column:
    """What a matching model is told about a candidate, as JSON."""
    return F.to_json(F.struct(*[F.coalesce(partner[k].cast("string"), F.lit("")).alias(k) for k in fixed.PAYLOAD_FIELDS if k in partner]))


def text_list(value: Column) -> Column:
    """The trimmed texts of an array that aren't blank; none for null."""
    return F.filter(F.transform(F.coalesce(value, F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: F.coalesce(x, F.lit("")) != "")


def first_of(value: Column) -> Column:
    """The first text of an array that isn't blank."""
    return F.get(text_list(value), F.lit(0))


def rationale(features: Column) -> Column:
    """The squeezed texts of an array that aren't blank."""
    return F.filter(F.transform(F.coalesce(features, F.array().cast("array<string>")), lambda x: squeeze(x)), lambda x: F.coalesce(x, F.lit("")) != "")


def is_specific(feature: Column) -> Column:
    return contains_any(F.lower(feature), fixed.SPECIFIC_MARKERS)


def is_generic(feature: Column) -> Column:
    return contains_any(F.lower(feature), fixed.GENERIC_MARKERS)


def accept_match(output_name: Column, score: Column, features: Column, partner_known: Column, strong: Column) -> Column:
    """The older accept rule as struct(accepted, reason); strong: whether the full assessment found a strong match."""
    name, s, f = F.trim(F.coalesce(output_name, F.lit(""))), F.lower(F.trim(F.coalesce(score, F.lit("")))), rationale(features)
    specific, generic = F.size(F.filter(f, lambda x: is_specific(x))), F.size(F.filter(f, lambda x: is_generic(x)))
    high, medium, low = s.isin("high", "hoch"), s.isin("medium", "mittel"), s.isin("low", "niedrig")
    said = lambda ok, why: F.struct(F.lit(ok).alias("accepted"), F.lit(why).alias("reason"))
    return (
        F.when(strong, said(True, "accepted_strong_validated_evidence")).when(name == "", said(False, "missing_partner_name"))
        .when(F.lower(name) == "no suitable match found", said(False, "explicit_no_match")).when(~partner_known, said(False, "matched_partner_data_missing"))
        .when(low, said(False, "low_match_score")).when(F.size(f) == 0, said(False, "missing_match_rationale"))
        .when(high & (specific == 0) & (generic >= 2), said(False, "high_match_but_rationale_too_generic")).when(high, said(True, "accepted_high_match"))
        .when(medium & (specific >= 1), said(True, "accepted_medium_match_with_specific_rationale")).when(medium, said(False, "medium_match_too_generic"))
        .otherwise(said(False, "rejected_weak_missing_evidence")))


def evidence_line(label: Column, value: Column) -> Column:
    """`label: value`, null where the value is blank; a label's underscores as spaces."""
    return F.concat(F.replace(label, F.lit("_"), F.lit(" ")), F.lit(": "), blank_to_null(value))


# ---------------------------------------------------------------- golden sets

def golden_numbers(cases: DataFrame, rows: DataFrame) -> DataFrame:
    """One row of metrics of cases(case_id, expected_number, required_outcome, forbidden array) against
    rows(case_id, top_1, top_2, top_3, outcome), with the release gate."""
    r = rows.select("case_id", *[F.trim(F.coalesce(c, F.lit(""))).alias(c) for c in ("top_1", "top_2", "top_3", "outcome")], F.lit(True).alias("_seen"))
    j = cases.join(r, "case_id", "left").withColumn("_seen", F.coalesce("_seen", F.lit(False)))
    number_ok = F.col("_seen") & (F.col("expected_number").isNull() | (F.col("top_1") == F.col("expected_number")))
    outcome_ok = F.col("_seen") & (F.col("required_outcome").isNull() | (F.col("outcome") == F.col("required_outcome")))
    wrong = F.col("_seen") & F.exists(text_list(F.col("forbidden")), lambda x: x.isin(F.col("top_1"), F.col("top_2"), F.col("top_3")))
    m = j.agg(F.count(F.lit(1)).alias("cases"), F.count_if(~F.col("_seen")).alias("missing"), F.count_if(number_ok).alias("number_passes"), F.count_if(outcome_ok).alias("outcome_passes"), F.count_if(wrong).alias("forbidden_failures"))
    rate = lambda c: F.round(F.coalesce(F.try_divide(c, F.col("cases")), F.lit(0.0)), 6)
    gate = (F.col("missing") == 0) & (F.col("forbidden_failures") == 0) & (F.col("number_passes") == F.col("cases")) & (F.col("outcome_passes") == F.col("cases"))
    return m.select("cases", "missing", rate(F.col("number_passes")).alias("number_pass_rate"), rate(F.col("outcome_passes")).alias("outcome_pass_rate"), "forbidden_failures", gate.alias("release_gate"))


def golden_matches(cases: DataFrame, rows: DataFrame) -> DataFrame:
    """One row of metrics of cases(case_id, expected, allowed array, forbidden array, confidence, expect_no_match,
    requires_pitch) against rows(case_id, matched, confidence_found, pitch, shortlist array)."""
    norm = lambda c: F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"\s+", " "))
    labels = lambda c: F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), norm), lambda x: x != "")
    j = cases.join(rows.withColumn("_seen", F.lit(True)), "case_id", "left").withColumn("_seen", F.coalesce("_seen", F.lit(False)))
    name, found = norm(F.col("matched")), F.lower(F.trim(F.coalesce("confidence_found", F.lit(""))))
    none = (name == "") | (name == "no suitable match found") | (found == "no_match")
    allowed = labels(F.col("allowed"))
    named = F.when(F.size(allowed) > 0, F.array_contains(allowed, name)).otherwise(F.col("expected").isNull() | (name == norm(F.col("expected"))))
    named = named & ~F.array_contains(labels(F.col("forbidden")), name)
    seen, no = F.col("_seen"), F.col("expect_no_match")
    ok = seen & F.when(no, none).otherwise(named)
    tp, fp, fn = seen & no & none, seen & no & ~none, seen & ~no & ~named & none
    listed = seen & (F.size(allowed) > 0)
    m = j.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~seen).alias("missing"), F.count_if(ok).alias("ok"), F.count_if(seen & (F.col("confidence").isNull() | (found == F.lower("confidence")))).alias("conf"),
        F.count_if(seen & (~F.col("requires_pitch") | (F.trim(F.coalesce("pitch", F.lit(""))) != ""))).alias("pitch"), F.count_if(tp).alias("tp"), F.count_if(fp).alias("fp"), F.count_if(fn).alias("fn"),
        F.count_if(seen & ~no & ~named).alias("false_negatives"), F.count_if(no).alias("no"), F.count_if(listed).alias("listed"), F.count_if(listed & F.arrays_overlap(allowed, labels(F.col("shortlist")))).alias("hits"))
    rate = lambda a, b: F.round(F.coalesce(F.try_divide(a, b), F.lit(0.0)), 6)
    c = F.col
    return m.select(
        c("n").alias("cases"), "missing", rate(c("ok"), c("n")).alias("partner_pass_rate"), rate(c("conf"), c("n")).alias("confidence_pass_rate"), rate(c("pitch"), c("n")).alias("pitch_pass_rate"),
        rate(c("tp"), c("tp") + c("fp")).alias("no_match_precision"), rate(c("tp"), c("tp") + c("fn")).alias("no_match_recall"), rate(c("fp"), c("no")).alias("false_positive_rate"),
        rate(c("false_negatives"), c("n") - c("no")).alias("false_negative_rate"), rate(c("hits"), c("listed")).alias("shortlist_recall"))
