"""Tasks over templates: inputs in place, statuses, coercions, partner rows, artifacts."""

import json

import pytest
from pyspark.sql import functions as F

from firmlens.operators import enrichment, inference


@pytest.fixture(scope="module")
def templates(spark):
    return enrichment.read_templates(spark)


def empty(spark):
    return spark.createDataFrame([], inference.CALLS)


def test_templates(spark, templates, tmp_path):
    assert set(templates) == set(enrichment.TASKS)
    (tmp_path / "summary.txt").write_text("Só: {{SCRAPED_WEBSITE_TEXT_PLACEHOLDER}} {{OTHER}}")
    own = enrichment.read_templates(spark, str(tmp_path))
    df = spark.createDataFrame([("a {{OTHER}} {{SCRAPED_WEBSITE_TEXT_PLACEHOLDER}}",), (" ",), (None,), ("x" * 30_000,)], "text string")
    got = [r[0] for r in df.select(enrichment.prompt_of("summary", own["summary"])).collect()]
    assert got == ["Só: a {{OTHER}} {{SCRAPED_WEBSITE_TEXT_PLACEHOLDER}} {{OTHER}}", None, None, "Só: " + "x" * 20_000 + " {{OTHER}}"]
    with pytest.raises(ValueError, match="lacks"):
        enrichment.prompt_of("pitch", own["summary"])


def test_statuses_and_coercions(spark, templates):
    def make():
        def answer(prompt):
            given = prompt.partition("\nInput:\n")[2].strip()
            if given == "boom":
                raise RuntimeError("no")
            if given == "prose":
                return "I can't", 1
            return 'So: {"is_b2b": " YES", "serves_1000_customers": "maybe", "extra": 1}', 1

        return answer

    rows = spark.createDataFrame([(1, "fine", "old"), (2, "boom", "old"), (3, "prose", "old"), (4, "  ", "old"), (5, None, "old"), (1, "fine", "old")], "id int, summary string, is_b2b string")
    got = sorted(tuple(r) for r in enrichment.run_task(rows, "capacity", templates, empty(spark), make).select("id", "is_b2b", "serves_1000_customers", "capacity_status").collect())
    assert got == [(1, "Yes", "Unknown", "ok"), (1, "Yes", "Unknown", "ok"), (2, None, None, "error"), (3, None, None, "unreadable"), (4, None, None, "no_input"), (5, None, None, "no_input")]
    assert not enrichment.run_task(rows.limit(0), "capacity", templates, empty(spark), make).count()


def test_every_task_by_the_rule_provider(spark, templates):
    ask = lambda df, task: enrichment.run_task(df, task, templates, empty(spark), enrichment.rule_provider).first()
    text = "Acme sells pipes and steel " + "word " * 200
    df = spark.createDataFrame([(text, text, text, text)], "text string, summary string, description string, bundle string")
    assert ask(df, "homepage").company_name == "Acme" and ask(df, "attributes").products_services_offered == ["Acme", "sells"]
    assert len(ask(df, "short_summary").german_summary.split()) == 100
    row = ask(df, "partner_row")
    assert [row[c] for c in ("Company Name", "Industry", "Website", "Rank (1-47)")] == ["Acme", "word", "", ""] and "Other" not in row and len(enrichment.PARTNER_COLUMNS) == 32
    about = enrichment.run_task(df, "attributes", templates, empty(spark), enrichment.rule_provider).select(enrichment.attributes_json().alias("attributes_json"), F.lit("{}").alias("partner_json"), F.lit(None).cast("string").alias("rationale"))
    assert json.loads(about.first()[0])["business_model"] is None
    assert ask(about, "pitch").phone_sales_line == "Guten Tag, es geht um word."


def test_artifacts(spark, tmp_path):
    calls = spark.createDataFrame([("t", "a" * 64, "Ask ü", "said", "ok", 1), ("t", "b" * 64, "x", None, "error", 0)], inference.CALLS)
    for _ in range(2):
        got = {r.path.rpartition("/")[2]: r.bytes for r in enrichment.write_artifacts(calls, f"file://{tmp_path}/a", "r1").collect()}
    assert got == {f"r1_t_{'a' * 24}_prompt.txt": 6, f"r1_t_{'a' * 24}_response.txt": 4, f"r1_t_{'b' * 24}_prompt.txt": 1, f"r1_t_{'b' * 24}_response.txt": 0}
    assert {p.name: p.stat().st_size for p in (tmp_path / "a").iterdir()} == got


def test_sales_report(spark):
    from firmlens.operators import outreach

    inputs = spark.createDataFrame([(1, "http://a", "A1", " ", "7", "Trade"), (2, "http://a", "A2", "'030", "8", "Steel"), (3, None, "N", "1", "2", "x"), (4, "http://b", "B", None, None, None)], "row_id long, GivenURL string, CompanyName string, PhoneNumber string, Number string, Industry string")
    outputs = spark.createDataFrame(
        [("http://a", "Kurz", "Hallo {programmatic placeholder}!", 2.5, ["x", "y"], True, None, ["p1"]), ("http://a", None, "Hallo {programmatic placeholder}!", None, None, False, "Own", []), ("http://c", None, None, 3.5, None, None, None, None), (None, None, None, None, None, None, None, None), ("http://b", "", "  ", 1.0, [], None, "", None)],
        "analyzed_company_url string, summary string, phone_sales_line string, avg_leads_per_day double, match_rationale_features array<string>, b2b_indicator boolean, industry string, shortlisted_partner_ids array<string>")
    report = outreach.sales_report(outputs, inputs)
    assert len(report.columns) == 65 and report.columns[:4] == ["Company Name", "Original_Number", "URL", "CanonicalEntryURL"] and report.columns[-1] == "ScrapeStatus"
    pick = ("Company Name", "Original_Number", "sales_pitch", "Short German Description", "match_reasoning", "shortlisted_partner_ids", "Industry", "B2B Indicator", "Avg Leads Per Day", "Original Row Number", "found_number", "matched_golden_partner")
    got = {(r["URL"], r["sales_pitch"]): [r[c] for c in pick] for r in report.collect()}
    assert got == {
        ("http://a", "Hallo 2!"): ["A2", "'030", "Hallo 2!", "Kurz", "x; y", "p1", "Steel", "True", "2.5", 3, None, ""],
        ("http://a", "Hallo {programmatic placeholder}!"): ["A2", "'030", "Hallo {programmatic placeholder}!", None, "", "", "Own", "", "", 3, None, ""],
        ("http://c", None): [None, None, None, None, "", "", None, "", "3.5", None, None, ""],
        (None, None): [None, None, None, None, "", "", None, "", "", None, None, ""],
        ("http://b", None): ["B", None, None, None, "", "", None, "", "1.0", 5, None, ""],
    }
    assert not outreach.sales_report(outputs.limit(0), inputs).count() and outreach.sales_report(outputs, inputs.limit(0)).count() == 5


def test_match_assessment(spark):
    from firmlens.operators import gate

    rows = [
        ("both", "Acme", "strong", None, "Buyer", ["x"], ["small dental labs"], ["labs for dentists"], ["We serve dental labs"], ["labs, dentists"], True, 0.0, None),
        ("fallback", "Acme", None, "Hoch", None, [" dental  labs ", "dental", "labs here"], ["nothing such"], None, ["We serve dental labs"], ["dental labs"], True, 0.0, None),
        ("one side", "Acme", "high", None, "odd kind", [], ["dental labs"], [], ["We serve dental labs"], ["other"], True, 0.9, ["a"]),
        ("weak", "Acme", "medium", None, "process", None, None, None, None, None, True, None, [" n/a ", "shared"]),
        ("weak without", "Acme", "weak", None, "process", None, None, None, None, None, True, None, [" "]),
        ("unknown", "Acme", "strong", None, "buyer", ["dental labs"], ["dental labs"], ["dental labs"], ["dental labs"], ["dental labs"], None, 1.0, ["a"]),
        ("no name", " ", "strong", None, "buyer", ["dental labs"], None, None, ["dental labs"], None, True, 1.0, ["a"]),
        ("none", None, None, None, None, None, None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "k string, matched_partner_name string, match_confidence string, match_score string, overlap_type string, match_rationale_features array<string>, target_evidence array<string>, partner_evidence array<string>, target_texts array<string>, partner_texts array<string>, partner_known boolean, shortlist_score double, shortlist_overlap_features array<string>")
    got = {r.k: (r.reason, r.match_confidence, r.overlap_type, r.target_evidence, r.partner_evidence) for r in gate.match_assessment(df).collect()}
    assert got == {
        "both": ("accepted_strong_validated_evidence", "strong", "audience", ["small dental labs"], ["labs for dentists"]),
        "fallback": ("accepted_strong_validated_evidence", "strong", "mixed", ["dental labs", "dental"], ["dental labs", "dental"]),
        "one side": ("rejected_strong_missing_evidence", "no_match", "odd kind", ["dental labs"], []),
        "weak": ("accepted_weak_match", "weak", "workflow", [], []),
        "weak without": ("rejected_weak_missing_evidence", "no_match", "workflow", [], []),
        "unknown": ("matched_partner_data_missing", "no_match", None, [], []),
        "no name": ("missing_partner_name", "no_match", None, [], []),
        "none": ("missing_partner_match_output", "no_match", None, [], []),
    }
