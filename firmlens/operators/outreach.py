"""The sales outreach report: an input row, what was found of it and the match it got, a line an output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlens.functions.text import blank_to_null, first_usable
from firmlens.operators.relations import last_wins

# The report's columns that are taken over from the input row by their names …
FROM_INPUT = (
    "CanonicalEntryURL", "PhoneNumber_Status", "input_phone_number", "retrieved_phone_number", "usable_phone_for_pitch", "phone_status", "is_b2b", "is_b2b_reason", "serves_1000",
    "serves_1000_reason", "found_number", "Top_Number_1", "Top_Type_1", "Top_SourceURL_1", "Top_Number_2", "Top_Type_2", "Top_SourceURL_2", "Top_Number_3", "Top_Type_3",
    "Top_SourceURL_3", "BestPersonContactName", "BestPersonContactRole", "BestPersonContactDepartment", "BestPersonContactNumber", "PersonContacts", "MainOffice_Number",
    "MainOffice_Type", "MainOffice_SourceURL", "LLMPhoneRanking", "LLMPhoneRankingError", "DeprioritizedNumbers", "SuspectedOtherOrgNumbers",
)
# … those of the match, and the output's fields they come from …
FROM_MATCH = (
    ("matched_golden_partner", "matched_partner_name"), ("matched_golden_partner_id", "matched_partner_id"), ("match_confidence", "match_confidence"), ("match_overlap_type", "overlap_type"),
    ("target_match_evidence", "target_evidence"), ("partner_match_evidence", "partner_evidence"), ("runner_up_partner_id", "runner_up_partner_id"), ("runner_up_partner_name", "runner_up_partner_name"),
    ("shortlisted_partner_ids", "shortlisted_partner_ids"), ("shortlisted_partner_names", "shortlisted_partner_names"), ("match_acceptance_reason", "acceptance_reason"),
    ("match_reasoning", "match_rationale_features"),
)
# … and those of the attributes.
FROM_ATTRIBUTES = (
    ("B2B Indicator", "b2b_indicator"), ("Phone Outreach Suitability", "phone_outreach_suitability"), ("Target Group Size Assessment", "target_group_size_assessment"),
    ("Products/Services Offered", "products_services_offered"), ("USP/Key Selling Points", "usp_key_selling_points"), ("Customer Target Segments", "customer_target_segments"),
    ("Business Model", "business_model"), ("Company Size Inferred", "company_size_category_inferred"), ("Innovation Level Indicators", "innovation_level_indicators_text"),
    ("Website Clarity Notes", "website_clarity_notes"),
)
LEADS_MARK = "{programmatic placeholder}"


def _cell(df: DataFrame, name: str) -> Column:
    """A field as a cell: lists joined, true as True, false and null as ''; null where the table has no such column."""
    kind = dict(df.dtypes).get(name)
    c = F.col(f"`{name}`")
    if kind is None:
        return F.lit(None).cast("string")
    if kind.startswith("array"):
        return F.coalesce(F.array_join(c, "; "), F.lit(""))
    if kind == "boolean":
        return F.when(c, "True").otherwise("")
    return F.coalesce(c.cast("string"), F.lit(""))


def pitch_line(line: Column, leads: Column) -> Column:
    """The line with its mark replaced by the leads a day as a whole number (halves to even); as it is without leads."""
    whole = F.bround(leads.cast("double"), 0).cast("long").cast("string")
    return F.when(leads.isNotNull(), F.replace(line, F.lit(LEADS_MARK), whole)).otherwise(line)


def sales_report(outputs: DataFrame, inputs: DataFrame) -> DataFrame:
    """The report's columns, in its order, of each output: analyzed_company_url, summary, phone_sales_line, avg_leads_per_day, rank,
    matched_partner_description, the fields of FROM_MATCH and the attributes, whichever there are.

    inputs: row_id (from 1) and the columns of the input list; its row with the output's address as GivenURL is the one it is
    about, of several the last. An output without one has no input columns; outputs and rows without address meet none. A
    row that several outputs name is joined to each; equal outputs stay. Input columns that the list doesn't have are null,
    match and attribute columns ''. Empty tables give no rows.
    """
    known = last_wins(inputs.where(blank_to_null(F.col("GivenURL")).isNotNull()), ["GivenURL"], "row_id")
    renamed = {c: f"_in_{c}" for c in known.columns}
    both = outputs.join(known.withColumnsRenamed(renamed), F.col("analyzed_company_url") == F.col("_in_GivenURL"), "left")
    own = lambda name: F.col(f"`_in_{name}`").cast("string") if name in inputs.columns else F.lit(None).cast("string")
    said = lambda name: _cell(outputs, name)
    filled = lambda c: F.coalesce(c, F.lit(""))
    leads = F.col("avg_leads_per_day") if "avg_leads_per_day" in outputs.columns else F.lit(None).cast("double")
    columns = {
        "Company Name": own("CompanyName"), "Original_Number": first_usable(own("Original_Number"), own("PhoneNumber"), own("Number")), "URL": F.col("analyzed_company_url"),
        **{c: own(c) for c in FROM_INPUT},
        "sales_pitch": pitch_line(blank_to_null(said("phone_sales_line")), leads), "Short German Description": first_usable(said("summary"), own("Short German Description"), own("Description")),
        **{c: filled(said(f)) for c, f in FROM_MATCH},
        "Industry": first_usable(said("industry"), own("Industry")), "Matched Partner Description": filled(said("matched_partner_description")), "Avg Leads Per Day": filled(leads.cast("string")), "Rank": filled(said("rank")),
        **{c: filled(said(f)) for c, f in FROM_ATTRIBUTES},
        "Original Row Number": (F.col("_in_row_id") + 1).cast("long"), "ScrapeStatus": own("ScrapingStatus"),
    }
    return both.select(*[c.alias(n) for n, c in columns.items()])
