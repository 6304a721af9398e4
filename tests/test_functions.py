"""Functions and operators on hand-written rows."""

import pytest
from pyspark.sql import functions as F

from firmlens.functions import phones, text, urls
from firmlens.operators import contacts, matching, relations
from firmlens.sources import delimited, html
from firmlens.streaming import rows


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) if v is not None else F.lit(None).cast("string").alias(k) for k, v in values.items()])
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("url", "want"), [
    ("HTTP://www.Example.com/a/index.html?b=2&a=1&fallback=1#x", "http://example.com/a?a=1&b=2"), ("https://example.com", "https://example.com/"),
    ("https://example.com/a/", "https://example.com/a"), ("https://example.com/?fallback", "https://example.com/"),
])
def test_normalize_url(spark, url, want):
    got = one(spark, urls.normalize(F.col("u")), u=url)
    assert got == want
    assert one(spark, urls.normalize(F.col("u")), u=got) == got


@pytest.mark.parametrize(("url", "want"), [("http://www.example.com/p?q", "http://example.com"), ("example.com/path", "http://example.com"), ("word", None), ("word/with.dot", None)])
def test_base_url(spark, url, want):
    assert one(spark, urls.base(F.col("u")), u=url) == want


@pytest.mark.parametrize(("url", "want"), [("https://a.de/kontakt", "contact"), ("https://a.de/impressum", "imprint"), ("https://a.de/agb", "legal"), ("https://a.de/", "homepage"), ("https://a.de/x", "general_content"), ("", "unknown")])
def test_page_type(spark, url, want):
    assert one(spark, urls.page_type(F.col("u")), u=url) == want


def test_link_score(spark):
    score = lambda u, t="": one(spark, urls.link_score(F.col("u"), F.col("t")), u=u, t=t)
    assert score("https://a.de/kontakt") == 100
    assert score("https://a.de/products") == 90
    assert score("https://a.de/a/b/c/products") == 85
    assert score("https://a.de/our-products-x") == 50
    assert score("https://a.de/x", "Our Team") == 40
    assert score("https://a.de/x") == 0


@pytest.mark.parametrize(("raw", "region", "want"), [("0049 30 1234567", "DE", "+49301234567"), ("030 1234567", "DE", "+49301234567"), ("(212) 555-0199", "US", "+12125550199"), ("nan", "DE", None), ("12", "DE", None)])
def test_e164(spark, raw, region, want):
    assert one(spark, phones.e164(F.col("c"), region), c=raw) == want


@pytest.mark.parametrize(("raw", "nsn", "want"), [("02.01.2026", "2012026", False), ("x", "5555501", False), ("x", "1234599", False), ("x", "9876500", False), ("x", "123", False), ("x", "3019273", True)])
def test_valid_number(spark, raw, nsn, want):
    assert one(spark, phones.valid(F.col("r"), F.col("n")), r=raw, n=nsn) is want


def test_needs_retrieval(spark):
    assert all(one(spark, phones.needs_retrieval(F.col("c")), c=c) for c in (None, " ", "N/A", "-", "12 34", "'"))
    assert not one(spark, phones.needs_retrieval(F.col("c")), c="'+49 30 1234567")


def test_role_score(spark):
    assert [one(spark, phones.role_score(F.col("c")), c=c) for c in ("CEO", "Head of Sales", "Hausmeister", "", "Someone")] == [100, 80, -50, 0, 10]


def test_match_text_folds_accents_and_deletes_sharp_s(spark):
    assert one(spark, text.match_text(F.col("c")), c="Größe & Café – B2B!") == "groe and cafe b2b"
    assert one(spark, text.match_tokens(F.col("c")), c="The HR software of 2024 in Köln") == ["hr", "koln"]


def test_clean_lines(spark):
    said = "Hello\nhello\nWe use cookies. Accept all\n\n  a   b \nCall +49 30 1234567 cookie\nA b"
    assert one(spark, text.clean_lines(F.col("c")), c=said) == "Hello\na b\nCall +49 30 1234567 cookie"


def test_json_pieces(spark):
    assert one(spark, text.fenced_json(F.col("c")), c='x ```json\n{"a": 1}\n``` y') == '{"a": 1}'
    assert one(spark, text.fenced_json(F.col("c")), c='x {"a": {"b": 1}} y') == '{"a": {"b": 1}}'
    assert one(spark, text.json_field(F.col("c"), "name"), c='{"name": "Acme", "x": "cut') == "Acme"


def test_html_text_drops_banner_but_not_one_with_a_number():
    page = '<html><head><style>p{}</style><script>x</script></head><body><div id="cookie-banner">We use cookies. Accept all</div><div class="consent-x">Cookie line +49 30 1234567</div><p>Hello <b>you</b></p><a href="/kontakt">Kontakt</a></body></html>'
    said, links = html.parse(page)
    assert "Accept all" not in said and "+49 30" in said and "Hello" in said and "x" not in said.split("\n")
    assert links == [["/kontakt", "Kontakt"]]
    assert html.parse(None) == ("", [])


def test_sniff_and_range():
    assert delimited.sniff_delimiter("a;b\n1;2,3") == ";"
    assert delimited.sniff_delimiter("") == ","
    assert [delimited.parse_range(x) for x in ("2-5", "3-", "-4", "7", "0", "", "x", None)] == [(2, 5), (3, None), (1, 4), (1, 7), (1, None), (1, None), (1, None), (1, None)]
    assert delimited.parse_range("5-90", total=10) == (5, 10)


def test_read_delimited_stops_after_blank_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Company;Website;Company\nA;a.de;\n;;\nB;b.de;BB\n;;\n;;\n;;\nC;c.de;\n")
    df = delimited.read_delimited(spark, f"file://{tmp_path}/a.csv")
    assert [r["Website"] for r in df.orderBy("row_id").collect()] == ["a.de", "b.de"]
    wide = delimited.read_delimited(spark, f"file://{tmp_path}/a.csv", rows="1-3", stop_blank=None)
    assert wide.count() == 3
    named = delimited.apply_profile(df.toDF("row_id", "Company", "website", "x"), "default", {"Industry": ""})
    assert {"CompanyName", "GivenURL", "Industry"} <= set(named.columns)


def test_coalesce_repeated(spark):
    df = spark.createDataFrame([("", "b"), ("a", "c")], "x string, x__2 string")
    assert [r["x"] for r in delimited.coalesce_repeated(df).collect()] == ["b", "a"]


def test_consolidation_does_not_depend_on_partitions(spark):
    data = [("s", f"+4930{i % 5}", c, t, f"http://s/{i % 3}", i) for i, (c, t) in enumerate([("Support", "Fax"), ("Primary", "Main Line"), ("Secondary", "Sales")] * 10)]
    df = spark.createDataFrame(data, "site string, number string, classification string, type string, original_full_url string, pos int")
    a = contacts.consolidate(df, "site", ["pos"]).orderBy("number").collect()
    b = contacts.consolidate(df.repartition(7, "pos"), "site", ["pos"]).orderBy("number").collect()
    assert a == b and all(r["classification"] == "Primary" for r in a)


def test_skip_private_number(spark):
    col = contacts.skip_private(F.col("t"), F.col("p"), F.array(F.col("r")), F.array(F.col("u")))
    assert one(spark, col, t="Mobile", p="", r="Assistant", u="/impressum")
    assert not one(spark, col, t="Mobile", p="", r="Vertrieb", u="/impressum")
    assert not one(spark, col, t="Main Line", p="null", r="", u="/impressum")


def test_best_person(spark):
    s = "array<struct<type string, associated_person_name string, associated_person_role string, is_direct_dial boolean>>".replace("struct<type string", "struct<type:string").replace(" string", ":string").replace(" boolean", ":boolean")
    df = spark.createDataFrame([("a", "+1", "Primary", [("Main", "Ann", "CEO", True), ("Fax", "Bob", "CEO", True)]), ("b", "+2", "Primary", [("Main", "null", "x", None)])], f"site string, number string, classification string, sources {s}")
    got = contacts.best_person(contacts.person_contacts(df, "site"), "site").collect()
    assert [(r["site"], r["name"], r["score"]) for r in got] == [("a", "Ann", 160)]


def test_shared_audience_beats_domain_and_mismatch_costs(spark):
    t = spark.createDataFrame([("t", "audience", "a"), ("t", "domain", "construction")], "target string, category string, tag string")
    p = spark.createDataFrame([("p", "audience", "a"), ("q", "domain", "construction"), ("r", "domain", "healthcare")], "partner string, category string, tag string")
    pairs = spark.createDataFrame([("t", x) for x in "pqr"], "target string, partner string")
    got = {r["partner"]: (r["score"], r["penalty"]) for r in matching.taxonomy_alignment(t, p, pairs).collect()}
    assert got == {"p": (26, 0), "q": (14, 0), "r": (-26, 26)}


def test_evidence(spark):
    col = matching.supported(F.col("e"), F.array(F.lit("We repair crane engines in Hamburg")))
    assert one(spark, col, e="crane engines") and one(spark, col, e="Hamburg crane works") and not one(spark, col, e="crane ships") and not one(spark, col, e="")


def test_relations_edges(spark):
    e = spark.createDataFrame([], "k long, v string, o long")
    assert relations.last_wins(e, ["k"], "o").count() == 0
    base = spark.createDataFrame([(1, " "), (2, "x"), (None, None)], "k long, v string")
    extra = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 3)], "k long, v string, o long")
    assert {(r["k"], r["v"]) for r in relations.overlay(base, extra, ["k"], ["v"], "o").collect()} == {(1, "b"), (2, "x"), (None, None)}
    assert relations.remaining(base, extra, ["k"]).count() == 1  # the row without a key stays
    assert {r["k"] for r in relations.missing_numbers(base, "k", 1, 4).collect()} == {3, 4}


def test_stream_resumes_without_doubles(spark, tmp_path):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    spark.range(10).selectExpr("id AS event_id", "'a' AS event_type").write.mode("append").parquet(src)
    schema = spark.read.parquet(src).schema
    go = lambda: rows.write_outputs(rows.row_events(spark, src, schema), {"rows": lambda b: b}, out, f"{tmp_path}/check")
    go()
    go()
    assert rows.read_output(spark, out, "rows").count() == 10
    spark.range(10, 13).selectExpr("id AS event_id", "'a' AS event_type").write.mode("append").parquet(src)
    go()
    assert rows.read_output(spark, out, "rows").count() == 13


def test_model_seam_asks_only_for_misses(spark):
    from firmlens.operators import inference, pressure

    prompts = spark.createDataFrame([("a b",), ("a b",), ("c",), (None,)], "prompt string")
    first = inference.ask(prompts, spark.createDataFrame([], inference.CALLS), "t", inference.rule_provider, workers=2)
    cache = spark.createDataFrame(first.collect(), inference.CALLS)
    assert {(r["prompt"], r["status"], r["tokens"]) for r in cache.collect()} == {("a b", "ok", 2), ("c", "ok", 1)}

    def broken():
        def provider(prompt):
            raise RuntimeError("429 too many")

        return provider

    again = inference.ask(prompts.union(spark.createDataFrame([("new",)], "prompt string")), cache, "t", broken).collect()
    assert {(r["prompt"], r["status"]) for r in again} == {("a b", "ok"), ("c", "ok"), ("new", "error")}
    assert [r["answer"]["words"] for r in inference.answers(cache, "is_b2b string, words long").orderBy("prompt").collect()] == [2, 1]
    assert len(inference.answers(cache, "array<struct<words:bigint>>").first()["answer"]) == 1
    assert [pressure.backoff(n) for n in (1, 2, 3, 10)] == [1, 2, 4, 30] and inference.callers(50, 6) == 6 and inference.callers(0, 6) == 1


def test_match_decisions(spark):
    def decide(name="Acme", conf="strong", score=None, known=True, t=True, p=True, short=0.0, feats=0, spec=0):
        c = matching.assess(F.lit(name).cast("string"), F.lit(conf).cast("string"), F.lit(score).cast("string"), F.lit(known), F.lit(t), F.lit(p), F.lit(short), F.lit(feats), F.lit(spec))
        return spark.range(1).select(c.alias("c")).first()["c"]["reason"]

    assert decide() == "accepted_strong_validated_evidence"
    assert decide(t=False) == "rejected_strong_missing_evidence"
    assert decide(t=False, short=0.03, feats=1, spec=1) == "downgraded_strong_missing_direct_evidence"
    assert decide(conf="medium", t=False, p=False) == "rejected_weak_missing_evidence"
    assert decide(conf=None, score="hoch") == "accepted_strong_validated_evidence"
    assert decide(name="No suitable match found") == decide(conf="low") == "explicit_no_match"
    assert decide(name=" ") == "missing_partner_name" and decide(known=False) == "matched_partner_data_missing"
    assert decide(name=None, conf=None) == "missing_partner_match_output"


def test_outcome_table(spark):
    base = dict(status="Success", base="b", base_status="Success", page_statuses=["Success"], regex_found=True, has_numbers=False, has_bundle=True, n_raw=0, llm_error=None, has_top=False, rerank_requested=False, rerank_error=None)

    def outcome(**change):
        v = base | change
        c = {k: F.array(*[F.lit(s) for s in x]).cast("array<string>") if isinstance(x, list) else F.lit(x).cast("string") if x is None else F.lit(x) for k, x in v.items()}
        r = spark.range(1).select(relations.row_outcome(c).alias("o"), c["rerank_requested"].alias("r")).select("o", relations.fault(F.col("o"), F.col("r")).alias("f")).first()
        return r["o"], r["f"]

    assert outcome(status="InvalidURL") == ("Input_URL_Invalid", "Input Data Issue")
    assert outcome(has_numbers=True, has_top=True) == ("Contact_Successfully_Extracted", "N/A")
    assert outcome(has_numbers=True, rerank_error="x") == ("Contact_Consolidated_RerankFailed_NoOperationalCallList", "LLM Issue")
    assert outcome(has_numbers=True, rerank_requested=True)[1] == "LLM Issue" and outcome(has_numbers=True)[1] == "Pipeline Logic/Configuration"
    assert outcome(base_status="Error", page_statuses=["DNS", "Timeout"]) == ("Scraping_AllAttemptsFailed_Network", "Website Issue")
    assert outcome(base_status="Error", page_statuses=["DNS", "404"]) == ("ScrapingFailed_Canonical_Error", "Website Issue")
    assert outcome(regex_found=False) == ("Canonical_NoRegexCandidatesFound", "Pipeline Logic/Configuration")
    assert outcome() == ("LLM_Output_NoNumbersFound_AllAttempts", "LLM Issue")


def test_prequalify_keeps_unknown_capacity(spark):
    c = lambda a, b: one(spark, relations.prequalify(F.col("a"), F.col("b")), a=a, b=b)
    assert c("Yes", "Unknown") is None and c("Yes", "No") == "Capacity_Under_1000" and c("Unknown", "Yes") == "Not_B2B" and c(None, None) == "B2B_Capacity_Check_Failed"


def test_rank_fusion_counts_only_the_first_ranks(spark):
    sparse = spark.createDataFrame([("t", "a", 9), ("t", "b", 5), ("t", "c", 1)], "target string, partner string, score long")
    dense = spark.createDataFrame([("t", "b", 0.9), ("t", "c", 0.8)], "target string, partner string, cosine double")
    got = [(r["partner"], round(r["fused"], 6)) for r in matching.rank_fusion(sparse, dense, k=60, top=2, keep=3).orderBy("place").collect()]
    assert got == [("b", round(1 / 62 + 1 / 61, 6)), ("a", round(1 / 61, 6)), ("c", round(1 / 62, 6))]


def test_reports(spark):
    from firmlens.operators import reports

    n = spark.createDataFrame([("s", "+1", "Primary", ["Main Line"]), ("s", "+2", "Primary", ["Fax"]), ("s", "+3", "Non-Business", ["Main Line"]), ("s", "+4", "Support", ["Sales"])], "site string, number string, classification string, types array<string>")
    assert reports.short_contacts(n, "site").first()["contacts"] == "+1 (Main Line); +4 (Sales)"
    assert one(spark, reports.redact(F.col("c")), c='{"api_key": "abc", "model": "m"}') == '{"api_key": "***", "model": "m"}'
    src = spark.createDataFrame([(1, " ", "a\x00b"), (2, "+49", "c")], "row_id long, phone string, note string")
    got = {r["row_id"]: (r["phone"], r["note"]) for r in reports.augmented(src, spark.createDataFrame([(1, "+1")], "row_id long, number_1 string"), "row_id", "phone").collect()}
    assert got == {1: ("+1", "ab"), 2: ("+49", "c")}
    rows = reports.failed_rows(spark.createDataFrame([(1, "A", "u")], "row_id long, CompanyName string, GivenURL string"), F.lit("x"), F.lit("a\nb"), "t").first()
    assert rows["error_reason"] == "a b"
