"""Lists, files, pages and models' answers against plain Python."""

import csv
import json
import random
import re
from urllib.parse import urljoin, urlsplit

import pyarrow.parquet as pq
import pytest
from conftest import TINY
from pyspark.sql import functions as F

from firmlens.functions import fixed, text, urls
from firmlens.operators import completion, ranking, relations
from firmlens.plans import catalog, runs, web
from firmlens.sources import delimited, files
from firmlens.sources import html as pages


def one(spark, column, **values):
    names = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], names).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("said", "want"), [
    ('ok {"a":1} and } more {x}', '{"a":1}'), ('x {"a": "}", "b": {"c": [1]}} tail', '{"a": "}", "b": {"c": [1]}}'), ('[1, {"a": "]"}] {', '[1, {"a": "]"}]'), ('{ never [1] closed', "[1]"),
    ('say \\" {"a": "q\\"}"}', '{"a": "q\\"}"}'), ("nothing", None), (None, None), ("", None), ('```json\n{"f": 1}\n``` {"g": 2}', '{"f": 1}'), ('```\nno\n``` {"g": 2}', '{"g": 2}'), ("}}} {{}}", "{{}}"),
])
def test_balanced_json(spark, said, want):
    assert one(spark, text.fenced_json(F.col("c")), c=said) == want


def test_lists_with_quotes_line_ends_and_blanks(spark, tmp_path):
    rows = [['A "x" Inc', "1"], ["two\nlines; here", "2"], ["", " "], ["c", "3"], ["", ""], ["", ""], ["", ""], ["late", "9"]]
    with open(tmp_path / "a.csv", "w", newline="", encoding="utf-8-sig") as f:
        csv.writer(f, delimiter=";").writerows([["Company", "n"], *rows])
    got = delimited.read_delimited(spark, str(tmp_path / "a.csv")).orderBy("row_id").collect()
    assert [tuple(r) for r in got] == [(1, 'A "x" Inc', "1"), (2, "two\nlines; here", "2"), (4, "c", "3")]
    assert delimited.count_rows(spark, str(tmp_path / "a.csv"), stop_blank=None) == 8
    assert [r["row_id"] for r in delimited.read_delimited(spark, str(tmp_path / "a.csv"), rows="2-4").orderBy("row_id").collect()] == [2, 4]


def test_rows_of_several_files_count_on(spark, tmp_path):
    for name, n in (("b", 3), ("a", 2)):
        with open(tmp_path / f"{name}.csv", "w", newline="") as f:
            csv.writer(f).writerows([["k", "v"], *[[f"{name}{i}", i] for i in range(n)]])
    assert [(r["row_id"], r["k"]) for r in delimited.read_delimited(spark, str(tmp_path)).orderBy("row_id").collect()] == [(1, "a0"), (2, "a1"), (3, "b0"), (4, "b1"), (5, "b2")]


def test_row_gaps_over_partitions(spark):
    ids = sorted(random.Random(1).sample(range(1, 400), 120))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = {r["row_id"]: r["gap"] for r in delimited.row_gaps(spark.createDataFrame([(i,) for i in ids], "row_id long").repartition(7), 1).collect()}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == {b: b - a - 1 for a, b in zip([0, *ids], ids)}


def test_partner_table_and_loader(spark, tmp_path):
    (tmp_path / "p.csv").write_text("Name,Rank,Other\nAcme, 1 ,x\nBeta,nan,\n")
    got = delimited.read_partners(spark, str(tmp_path / "p.csv"), {"name": "name", "rank": "rank"}, ["name", "rank", "usp"]).orderBy("row_id").collect()
    assert [tuple(r)[1:] for r in got] == [("Acme", "1", ""), ("Beta", "", "")]
    (tmp_path / "c.csv").write_text("Company,Website,PhoneNumber,Company\nA,http://a,'030 1234567,B\n,http://b,none,B\nCompanyName,x,y,z\n")
    got = delimited.load_companies(spark, str(tmp_path / "c.csv"), phone_region="DE").orderBy("row_id").collect()
    assert [(r["CompanyName"], r["GivenURL"], r["NormalizedGivenPhoneNumber"]) for r in got] == [("A", "http://a", "+49301234567"), ("B", "http://b", None)]


def test_cache_folders_and_inventory(spark, tmp_path):
    for p in ("run/scraped_content/a.txt", "run/scraped_content/b.txt", "run/workers/1/scraped_content/c.txt", "a/b/c/d/e/scraped_content/x.txt", "other/y.txt"):
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_text("x")
    assert {r["folder"]: r["files"] for r in files.cache_folders(spark, str(tmp_path)).collect()} == {"run/scraped_content": 2, "run/workers/1/scraped_content": 1}
    assert {r["relative_path"]: r["size_bytes"] for r in files.inventory(spark, str(tmp_path)).collect()}["other/y.txt"] == 1


def test_contact_entries():
    page = "Alan Turing\n+44 1 234567\nTeam\nMehr lesen: x\nAda Byron\nLeiterin Vertrieb\nTel. 030 1234\nada@example.com\nGrace Hopper\n+49 30 99 88\nEmmy Noether\nProfessorin\nkein Eintrag\nMax von Laue\nDownload alles"
    assert files.contact_entries(page) == ["Ada Byron | Leiterin Vertrieb | 030 1234 | ada@example.com", "Grace Hopper | +49 30 99 88"]
    assert files.contact_entries(None) == files.contact_entries("") == []


def test_contact_blocks_brute_force(spark):
    """The query's pages, made again in Python."""
    names = ("Ada Byron", "Emmy Noether", "Max von Laue", "Grace Hopper")
    got = {r["c_custkey"]: r["contacts"] for r in catalog.QUERIES["contact_blocks"](spark, TINY).collect()}
    for k, said in got.items():
        name = names[k % 4]
        role = "Leiterin Vertrieb" if k % 3 else ""
        tel, mail = f"030 {k + 100}" if k % 5 else "", f"x{k}@example.com" if k % 7 else ""
        if name == "Max von Laue":  # no name of capitalized words; the line that follows looks like one
            name, role = role, ""
        own = "" if not name or not (tel or mail) else " | ".join(x for x in (name, role or ("" if tel else "E-Mail senden"), tel, mail) if x)
        if k % 2 == 0:
            assert said == own, (k, said, own)
        else:  # without a heading the first name's values reach over the lines that follow
            assert said.startswith("Alan Turing | +44 1 234567") and (not mail or mail in said), (k, said)


def anchors(source):
    parser = pages._Page()
    parser.feed(source or "")
    return parser.links


def plain_score(url, said):
    words, n = web.LINK_WORDS, 3
    segments = [s for s in urlsplit(url).path.lower().split("/") if s]
    over = max(0, len(segments) - n)
    if not any(w in url.lower() or w in said.lower() for w in words["target"]) and not any(s in words["force"] for s in segments):
        return None
    best = 100 if any(s in words["force"] for s in segments) else 0
    for i, s in enumerate(segments):
        if s in words["critical"]:
            best = max(best, 100 - min(20, 5 * over))
        if s in words["high"]:
            best = max(best, 90 - min(20, 5 * over))
        if s in words["critical"] + words["high"]:
            best = max(best, 80 - 5 * i - min(15, 5 * over))
        elif s in words["target"]:
            best = max(best, 70 - min(10, 3 * over))
        if any(w in s for w in words["target"]):
            best = max(best, 50)
    return max(best, 40) if any(w in said.lower() for w in words["target"]) else best


def test_link_topk_brute_force(spark):
    got = {}
    for r in catalog.QUERIES["link_topk"](spark, TINY).collect():
        got.setdefault(r["page_id"], []).append((r["place"], r["link"], r["score"]))
    norm = lambda u: u.split("#")[0].rstrip("/").replace("://www.", "://")
    d = pq.read_table(f"{TINY}/pages.parquet").to_pandas()
    checked = 0
    for page, url, source in zip(d.page_id, d.url, d.html):
        scored = {}
        for href, said in anchors(source):
            full = urljoin(url, href)
            host = lambda u: urlsplit(u).netloc.lower().removeprefix("www.")
            if urlsplit(full).scheme in ("http", "https") and host(full) == host(url) and not any(x in urlsplit(full).path.lower() for x in (*fixed.EXCLUDED_PATHS, "/los")):
                s = plain_score(norm(full), said)
                if s is not None:
                    scored[norm(full)] = max(s, scored.get(norm(full), 0))
        want = sorted(scored.items(), key=lambda x: (-x[1], x[0]))[:3]
        assert [s for _, _, s in sorted(got.get(page, []))] == [s for _, s in want], (page, got.get(page), want)
        assert {x for _, x, s in got.get(page, []) if sum(v == s for v in scored.values()) == 1} <= {x for x, _ in want}
        checked += len(want)
    assert checked > 10


def test_html_text_brute_force(spark):
    """The pages' text by another parser: tags cut by a pattern; these pages have no cookie banners that go."""
    import hashlib
    import html

    got = {r["page_id"]: r for r in catalog.QUERIES["html_text"](spark, TINY).collect()}
    d = pq.read_table(f"{TINY}/pages.parquet").to_pandas()
    for page, source in zip(d.page_id, d.html):
        bare = re.sub(r"(?is)<(script|style)\b.*?</\1\s*>", "\x00", source or "")
        bare = re.sub(r"(?s)<!--.*?-->", "\x00", bare)
        pieces = [html.unescape(p) for p in re.split(r"\x00|<[!/?a-zA-Z][^>]*>", bare)]
        lines, seen = [], set()
        for line in "\n".join(p.strip() for p in pieces if p.strip()).split("\n"):
            line = re.sub(r"\s+", " ", line).strip()
            low = line.lower()
            cookie = sum(m in low for m in fixed.COOKIE_MARKERS) >= 2 or (("cookie" in low or "consent" in low) and len(low) <= 240)
            if low and low not in seen and (not cookie or re.search(fixed.PHONE_OR_EMAIL, low)):
                seen.add(low)
                lines.append(line)
        want = "\n".join(lines)
        assert got[page]["text_md5"] == hashlib.md5(want.encode()).hexdigest(), (page, want[:200])


def test_link_tiers(spark):
    score = lambda u, t="": one(spark, urls.link_score(F.col("u"), F.col("t")), u=u, t=t)
    assert score("http://a.de/team") == 70 and score("http://a.de/a/b/c/d/team") == 64 and score("http://a.de/about-us") == 100 and score("http://a.de/x/products") == 90
    assert score("http://a.de/ourteam") == 50 and score("http://a.de/x", "Our team") == 40 and score("http://a.de/x", "more") == 0 and score("http://a.de/kontakt") == 100


def test_small_helpers(spark):
    assert completion.pick_column(["A ", "b"], "x", "a") == "A " and completion.pick_column(["b"], "x") is None
    assert completion.is_retrieved_column(" Found_Number ") and not completion.is_retrieved_column(None)
    assert one(spark, completion.html_usable(F.col("c")), c="x" * 300) == "usable" and one(spark, completion.html_usable(F.col("c")), c="Cloudflare " * 40) == "rejected_block_keyword:cloudflare"
    assert one(spark, completion.html_usable(F.col("c")), c="ab") == "rejected_too_short:2<200" and one(spark, completion.html_usable(F.col("c")), c=None) == "empty_html"
    assert one(spark, ranking.same_number(F.col("a"), F.col("b")), a="030 1234567", b="+49301234567") and not one(spark, ranking.same_number(F.col("a"), F.col("b")), a="", b="")
    assert one(spark, ranking.coerce_enum(F.col("c"), ("Primary", "Non-Business"), "Unknown"), c=" primary ") == "Primary" and one(spark, ranking.coerce_enum(F.col("c"), ("Primary",), "Unknown"), c=None) == "Unknown"
    assert one(spark, completion.evidence_line(F.lit("target_audience"), F.col("c")), c=" x ") == "target audience: x"
    assert one(spark, F.to_json(completion.text_list(F.array("c", F.lit(" a "), F.lit(" ")))), c=None) == '["a"]' and one(spark, completion.first_of(F.array("c", F.lit(" a "))), c="") == "a"
    t = spark.createDataFrame([("a", 2.0), ("a", 0.0), ("b", 0.0)], "task string, s double")
    assert {tuple(r) for r in relations.average_durations(t, "task", "s").collect()} == {("a", "2.00"), ("b", "N/A")}
    assert {tuple(r) for r in relations.failure_counts(t, "task").collect()} == {("a", 2), ("b", 1)}
    assert json.loads(one(spark, completion.prompt_payload({"name": F.col("c"), "usp": F.lit(None)}), c="A")) == {"name": "A", "usp": ""}


def test_schemas():
    from firmlens.operators import tasks

    schema = {"$defs": {"N": {"type": "string", "title": "x"}}, "properties": {"a": {"$ref": "#/$defs/N"}, "b": {"anyOf": [{"$ref": "#/$defs/N"}, {"type": "null"}], "default": None}, "c": [{"title": "y", "type": "integer"}]}}
    assert tasks.inline_references(schema) == {"properties": {"a": {"type": "string", "title": "x"}, "b": {"default": None, "type": "string", "title": "x", "nullable": True}, "c": [{"title": "y", "type": "integer"}]}}
    assert tasks.drop_keys(schema, ["title", "$defs"])["properties"]["c"] == [{"type": "integer"}]
    with pytest.raises(ValueError):
        tasks.inline_references({"$defs": {"N": {"x": {"$ref": "#/$defs/N"}}}, "a": {"$ref": "#/$defs/N"}})


def test_larger_partner_tables_are_refused(spark, monkeypatch):
    from firmlens.operators import matching

    t = spark.createDataFrame([(1, [1, 2], [1, 2, 3])], "target long, own array<long>, dense array<long>")
    p = spark.createDataFrame([(7, 1, [1], [1]), (8, 2, [9], [9]), (9, 3, [], [])], "partner long, position long, sparse array<long>, dense array<long>")
    got = matching.score_partners(t, p, {"own": 2}).collect()
    assert [(r["partner"], r["score"], r["terms"], r["sparse_rank"], r["place"]) for r in got] == [(7, 2, 1, 1, 1)]
    assert matching.score_partners(t, p.where("false"), {"own": 2}).count() == 0 and matching.score_partners(t.where("false"), p, {"own": 2}).count() == 0
    monkeypatch.setattr(matching, "MAX_TERMS", 3)
    with pytest.raises(ValueError):
        matching.score_partners(t, p, {"own": 2})


def test_manifest_and_history(spark, tmp_path):
    from datetime import datetime

    from firmlens.operators import reports

    out = tmp_path / "out"
    out.mkdir()
    (out / "a.csv").write_text("k\n1\n")
    at = datetime(2024, 5, 6, 7, 8, 9)
    for i, status in enumerate(("failed", "completed")):
        m = reports.manifest(spark, reports.run_id(at.replace(second=i), "x"), at, at, status=status, pipeline="p", source="in.csv", settings={"a": 1, "llm": {"api_key": "s", "n": [{"token": "t"}]}}, outputs=files.inventory(spark, str(out)))
        reports.append_history(m, str(tmp_path / "history"))
    h = relations.history(spark.read.json(str(tmp_path / "history")), pipeline="p", status="completed", contains="X", last=5).collect()
    assert [(r["run_id"], r["files"], r["bytes"]) for r in h] == [("20240506_070801_x", 1, 4)] and json.loads(h[0]["settings"]) == {"a": 1, "llm": {"api_key": "***", "n": [{"token": "***"}]}}
    text = reports.examples_markdown(spark.createDataFrame([("b", None), ("a", "x")], "k string, v string"), "T", ["k", "v"])
    assert text == "# T\n\n## 1\n- k: a\n- v: x\n\n## 2\n- k: b"
    with pytest.raises(ValueError):
        reports.metrics_markdown(spark.range(1001).selectExpr("CAST(id AS STRING) AS name", "id AS value"), "T")


def test_settings_and_logs(spark):
    from firmlens.functions import phones
    from firmlens.sources import records

    assert phones.parse_regions("['de', \"CH\"]") == ("DE", "CH") and phones.parse_regions("de, at,de") == ("DE", "AT") and phones.parse_regions(None) == phones.parse_regions("49") == ("DE", "AT", "CH")
    log = spark.createDataFrame([("x",), ("Loaded 12 rows",), ("now 15 rows to do",), ("end",)], "value string").coalesce(1)
    assert records.expected_rows(log).first()["rows"] == 15
    assert one(spark, F.to_json(phones.other_numbers(F.array("a", "b", "a"), F.array("b"))), a="1", b="2") == '["1"]'
    assert one(spark, urls.sales_url(F.col("a"), F.col("b")), a=" ", b="http://b") == "http://b"


def test_csv_scan_writes_in_parts(spark, monkeypatch, tmp_path):
    read, path = runs.read, str(tmp_path / "csv")
    monkeypatch.setattr(runs, "read", lambda *a: read(*a).repartition(4))
    monkeypatch.setattr(runs, "shared_folder", lambda *a: path)
    assert runs.csv_scan(spark, TINY).count() == read(spark, TINY, "customer").count()
    assert len(list(tmp_path.glob("csv/part-*"))) == 4
