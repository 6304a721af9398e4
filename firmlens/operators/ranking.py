"""Model rankings joined back to callable numbers, evidence for them, and the best of several model outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmlens.functions import fixed, phones
from firmlens.functions.text import blank_to_null
from firmlens.operators import contacts


def source_text(field: str) -> Column:
    """Distinct values of a field of `sources`, sorted, as one text."""
    return F.array_join(F.array_sort(F.array_distinct(F.filter(F.transform("sources", lambda s: s[field]), lambda x: x.isNotNull() & (x != "")))), ", ")


def ranked_numbers(items: DataFrame, numbers: DataFrame, site: str, most: int = 3) -> DataFrame:
    """items(site, pos, number, type, priority_label) of a model's ranking on the site's callable numbers, in its order:
    (site, place, number, type, source_urls) of the first `most`.

    Items that name no known number go, as do low-value ones and private numbers that only an imprint shows. An item that
    stands twice counts at its first place. The type is the item's, else the number's types, else Unknown.
    """
    n = numbers.select(site, "number", source_text("type").alias("_types"), source_text("original_full_url").alias("source_urls"), "sources")
    label = F.lower(F.trim(F.coalesce("priority_label", F.lit(""))))
    known = items.select(site, "pos", F.trim("number").alias("number"), "type", label.alias("_label")).join(n, [site, "number"])
    one = F.array_max(F.transform("sources", lambda s: s["associated_person_name"]))
    private = contacts.skip_private(F.col("type"), one, F.transform("sources", lambda s: s["associated_person_role"]), F.transform("sources", lambda s: s["source_path"]))
    known = known.where((F.col("_label") != "low value") & ~private)
    first = known.groupBy(site, "number").agg(F.min_by(F.struct("pos", "type", "_types", "source_urls"), F.col("pos")).alias("_i")).select(site, "number", "_i.*")
    ranked = first.withColumn("place", F.row_number().over(Window.partitionBy(site).orderBy("pos", "number"))).where(F.col("place") <= most)
    return ranked.select(site, "place", "number", F.coalesce(blank_to_null(F.col("type")), blank_to_null(F.col("_types")), F.lit("Unknown")).alias("type"), "source_urls")


def known_of(listed: DataFrame, numbers: DataFrame, site: str) -> DataFrame:
    """Per site the listed(site, pos, number) numbers that it has, once each, in first-seen order, as one text."""
    known = listed.select(site, "pos", F.trim("number").alias("number")).join(numbers.select(site, "number").distinct(), [site, "number"], "left_semi")
    once = known.groupBy(site, "number").agg(F.min("pos").alias("pos"))
    return once.groupBy(site).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "number"))), lambda x: x["number"]), "; ").alias("numbers"))


def outreach(sites: DataFrame, numbers: DataFrame, items: DataFrame, backups: DataFrame, deprioritized: DataFrame, other_org: DataFrame, site: str) -> DataFrame:
    """A row a site: number_1 … type_3 of its ranking, the main office's number as a backup, and which of its numbers are
    deprioritized or look like another organization's. backups: (site, number, type)."""
    top = ranked_numbers(items, numbers, site)
    top = top.groupBy(site).agg(*[F.max(F.when(F.col("place") == i, F.col(c))).alias(f"{c}_{i}") for i in (1, 2, 3) for c in ("number", "type")])
    known = numbers.select(site, F.col("number").alias("main_office"), source_text("original_full_url").alias("main_office_urls"))
    office = backups.select(site, F.trim("number").alias("main_office"), F.coalesce(blank_to_null(F.col("type")), F.lit("Main Office")).alias("main_office_type")).join(known, [site, "main_office"])
    out = sites.select(site).distinct().join(top, site, "left").join(office, site, "left")
    for name, listed in (("deprioritized", deprioritized), ("other_org", other_org)):
        out = out.join(known_of(listed, numbers, site).withColumnRenamed("numbers", name), site, "left")
    return out


def greedy_top(numbers: DataFrame, persons: DataFrame, site: str, order: list[Column], most: int = 3) -> DataFrame:
    """Numbers by slots: the best person's, the first sales line, the first main line, then the next ones in order.
    persons: (site, number) of the best persons."""
    types = F.lower(F.array_join("types", ", "))
    n = numbers.join(persons.select(site, "number").distinct().withColumn("_person", F.lit(True)), [site, "number"], "left")
    sales, main = types.rlike("sales|vertrieb"), types.rlike("main|zentrale|headquarter|head office")
    person = F.coalesce("_person", F.lit(False))
    # whatever a site has, only the first few of all, of persons, of sales lines (without persons too) and of main lines can get a slot
    kinds = F.array(F.lit("all"), F.when(person, "person"), F.when(sales, "sales"), F.when(sales & ~person, "other sales"), F.when(main, "main"))
    n = n.withColumn("_kind", F.explode(F.array_compact(kinds)))
    n = n.withColumn("_n", F.row_number().over(Window.partitionBy(site, "_kind").orderBy(*order))).where(F.col("_n") <= max(most, 3))
    n = n.withColumn("_n", F.row_number().over(Window.partitionBy(site, "number").orderBy("_kind"))).where(F.col("_n") == 1)
    n = n.withColumn("_at", F.row_number().over(Window.partitionBy(site).orderBy(*order)))
    first = lambda c: F.min(F.when(c, F.col("_at")))
    slots = n.groupBy(site).agg(first(person).alias("p"), first(sales).alias("s1"), first(sales & ~person).alias("s2"))
    n = n.join(slots, site).withColumn("_s", F.when(F.col("s1") == F.col("p"), F.col("s2")).otherwise(F.col("s1")))
    mains = n.where(main & ~F.col("_at").eqNullSafe(F.col("p")) & ~F.col("_at").eqNullSafe(F.col("_s"))).groupBy(site).agg(F.min("_at").alias("m"))
    n = n.join(mains, site, "left")
    slot = F.when(F.col("_at") == F.col("p"), 1).when(F.col("_at") == F.col("_s"), 2).when(F.col("_at") == F.col("m"), 3).otherwise(4)
    n = n.withColumn("place", F.row_number().over(Window.partitionBy(site).orderBy(slot, "_at"))).where(F.col("place") <= most)
    return n.select(site, "place", "number")


def legacy_columns(numbers: DataFrame, site: str) -> DataFrame:
    """The first primary and the first two secondary numbers of a site by diagnostic score, faxes too."""
    score = contacts.diagnostic_score(F.col("classification"), F.col("types"), F.exists("sources", lambda s: phones.person_text(s["associated_person_name"]).isNotNull()))
    n = numbers.where(F.trim("classification").isin("Primary", "Secondary")).withColumn("_score", score)
    n = n.withColumn("_n", F.row_number().over(Window.partitionBy(site, F.trim("classification")).orderBy(F.desc("_score"), "number"))).where(F.col("_n") <= 2)
    pick = lambda kind, i: F.max(F.when((F.trim("classification") == kind) & (F.col("_n") == i), F.col("number")))
    return n.groupBy(site).agg(pick("Primary", 1).alias("primary_1"), pick("Secondary", 1).alias("secondary_1"), pick("Secondary", 2).alias("secondary_2"))


def unique_items(items: DataFrame, site: str, pos: str = "pos") -> DataFrame:
    """A model's items (site, pos, number, …) without those that have no number, each number of a site once: at its first place."""
    rest = [c for c in items.columns if c not in (site, "number")]
    known = items.withColumn("number", F.trim("number")).where(F.coalesce("number", F.lit("")) != "")
    first = known.groupBy(site, "number").agg(F.min_by(F.struct(*rest), F.col(pos)).alias("_i"))
    return first.select(*[F.col(c) if c in (site, "number") else F.col(f"_i.{c}").alias(c) for c in items.columns])


def left_over(items: DataFrame, candidates: DataFrame, chosen: DataFrame, site: str, order: list[Column], *, most: int = 2) -> tuple[DataFrame, DataFrame]:
    """What a row's numbers leave out, for a report of examples: a model's unique items, and up to `most` snippets a site, whose number
    is none of chosen(site, number)."""
    taken = chosen.select(site, F.trim("number").alias("number")).where("number <> ''").distinct()
    excluded = unique_items(items, site).join(taken, [site, "number"], "left_anti")
    rest = candidates.withColumn("number", F.trim("number")).where(F.coalesce("number", F.lit("")) != "").join(taken, [site, "number"], "left_anti")
    rest = rest.withColumn("place", F.row_number().over(Window.partitionBy(site).orderBy(*order))).where(F.col("place") <= most)
    return excluded, rest


def snippet_evidence(candidates: DataFrame, site: str, order: list[Column], *, most: int = 3, longest: int = 220) -> DataFrame:
    """Per number of a site its first `most` different (source_url, excerpt), excerpts cut to `longest` characters."""
    said = F.trim(F.coalesce("snippet", F.lit("")))
    cut = F.when(F.length(said) > longest, F.concat(F.rtrim(F.left(said, F.lit(longest - 1))), F.lit("…"))).otherwise(said)
    c = candidates.withColumns({"excerpt": cut, "number": F.trim("number")}).where((F.col("excerpt") != "") & (F.col("number") != ""))
    once = c.groupBy(site, "number", "source_url", "excerpt").agg(F.min(F.struct(*order)).alias("_at"))
    once = once.withColumn("place", F.row_number().over(Window.partitionBy(site, "number").orderBy("_at", "source_url", "excerpt"))).where(F.col("place") <= most)
    return once.select(site, "number", "place", "source_url", "excerpt")


def rerank_payload(numbers: DataFrame, site: str, order: list[Column], *, most: int = 25, sources: int = 6) -> DataFrame:
    """What a ranking model is asked about, as JSON: the first `most` numbers of a site with up to `sources` sources each."""
    n = numbers.withColumn("place", F.row_number().over(Window.partitionBy(site).orderBy(*order))).where(F.col("place") <= most)
    evidence = F.slice(F.transform("sources", lambda s: F.struct(s["original_full_url"].alias("source_url"), s["type"].alias("type"), phones.person_text(s["associated_person_name"]).alias("person"))), 1, sources)
    return n.select(site, "place", "number", F.to_json(F.struct("number", F.trim("classification").alias("classification"), F.col("types").alias("types_seen"), evidence.alias("evidence_sources"))).alias("payload"))


def output_score(is_valid: Column, classification: Column, kind: Column, person: Column, role: Column) -> Column:
    """How good a model's output for a number is."""
    bonus = F.create_map(*[F.lit(x) for kv in fixed.OUTPUT_TYPES.items() for x in kv])
    c = F.trim(F.coalesce(classification, F.lit("")))
    return (
        F.when(is_valid, 100).otherwise(0) + F.when(c == "Primary", 30).when(c == "Secondary", 10).when(c == "Non-Business", -50).otherwise(0)
        + F.coalesce(bonus[F.trim(kind)], F.lit(0)) + F.when(F.trim(person) != "", 5).otherwise(0) + F.when(F.trim(role) != "", 3).otherwise(0))


def same_number(a: Column, b: Column) -> Column:
    """Whether two numbers are the same, as they stand or normalized."""
    x, y = F.trim(F.coalesce(a, F.lit(""))), F.trim(F.coalesce(b, F.lit("")))
    return (x != "") & (y != "") & ((x == y) | (phones.e164_any(x) == phones.e164_any(y)))


def best_outputs(inputs: DataFrame, outputs: DataFrame, row: str) -> DataFrame:
    """inputs(row, number, source_url) with the best of the model's outputs for it, or needs_retry.

    An output belongs to the first input with its number and URL, else with its normalized number and URL, else with the
    number alone, else with the normalized number. Of an input's outputs the best score wins, the earliest among equals.
    outputs: out_id, number, source_url, is_valid, classification, type, person, role.
    """
    low = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    bare = F.trim(F.coalesce("number", F.lit("")))
    num, norm = F.col("_num"), F.col("_norm")  # columns of their own, so that a number is normalized once, not once a way
    spell = lambda df: df.withColumn("_num", bare).where("_num <> ''").withColumn("_norm", phones.e164_any(F.col("_num")))
    ways = (F.concat_ws("|", num, low("source_url")), F.concat_ws("|", norm, low("source_url")), num, norm)
    # an input can be found by any of its spellings; an output tries its own ways in order
    spelled = F.array(*[F.struct(F.lit(level).alias("level"), key.alias("key")) for level, key in ((0, ways[0]), (1, ways[0]), (0, ways[1]), (1, ways[1]), (2, ways[2]), (3, ways[2]), (2, ways[3]), (3, ways[3]))])
    a = spell(inputs).select(row, F.explode(spelled).alias("k")).select(row, "k.*").groupBy("level", "key").agg(F.min(row).alias(row))
    b = spell(outputs).select("*", F.explode(F.array(*[F.struct(F.lit(i).alias("level"), w.alias("key")) for i, w in enumerate(ways)])).alias("k")).select("*", "k.*").drop("k")
    placed = b.join(a, ["level", "key"]).groupBy("out_id").agg(F.min_by(F.struct(row, "classification", "type", "is_valid", "person", "role"), F.col("level")).alias("o")).select("out_id", "o.*")
    placed = placed.withColumn("score", output_score(F.col("is_valid"), F.col("classification"), F.col("type"), F.col("person"), F.col("role")))
    best = placed.groupBy(row).agg(F.max_by(F.struct("out_id", "classification", "type", "score"), F.struct("score", -F.col("out_id"))).alias("b"))
    return inputs.join(best.select(row, "b.*"), row, "left").withColumn("needs_retry", F.col("out_id").isNull())


def coerce_enum(value: Column, allowed: tuple[str, ...], other: str) -> Column:
    """The allowed value that the text is in any case, else `other`."""
    table = F.create_map(*[F.lit(x) for a in allowed for x in (a.lower(), a)])
    return F.coalesce(table[F.lower(F.trim(F.coalesce(value, F.lit(""))))], F.lit(other))


def domain_outcome(c: dict[str, Column]) -> Column:
    """struct(outcome, fault) of a domain. c: has_numbers, status, page_statuses (array), regex_found, pages, llm_called,
    llm_error, n_raw."""
    every = lambda words: F.forall(c["page_statuses"], lambda s: F.coalesce(s, F.lit("")).rlike("|".join(words)))
    status = F.coalesce(c["status"], F.lit("Unknown"))
    failed, none = status != "Success", F.size(c["page_statuses"]) == 0
    said = lambda outcome, of: F.struct((F.lit(outcome) if isinstance(outcome, str) else outcome).alias("outcome"), F.lit(fixed.FAULTS.get(of, "N/A")).alias("fault"))
    network = "Scraping_AllAttemptsFailed_Network"
    return (
        F.when(c["has_numbers"], said("Contact_Successfully_Extracted_For_Domain", ""))
        .when(failed & none & status.rlike("InvalidURL|MaxRedirects"), said(F.concat(F.lit("Domain_InputLikeFailure_"), status), "Input_URL_Invalid"))
        .when(failed & none, said("Scraping_NoPathfulURLs_Processed_ForDomain", network))
        .when(failed & every(("Timeout", "DNS", "Network", "Unreachable")), said("Scraping_AllPathfulsFailed_Network_ForDomain", network))
        .when(failed & every(("403", "AccessDenied", "Robots")), said("Scraping_AllPathfulsFailed_AccessDenied_ForDomain", "Scraping_AllAttemptsFailed_AccessDenied"))
        .when(failed & every(("404", "NotFound")), said("Scraping_AllPathfuls_ContentNotFound_ForDomain", "Scraping_ContentNotFound_AllAttempts"))
        .when(failed, said(F.concat(F.lit("ScrapingFailed_Domain_"), status), network))
        .when(~c["regex_found"] & (c["pages"] == 0), said("Scraping_Success_NoPagesScraped_ForDomain", "Scraping_Success_NoRelevantContentPagesFound"))
        .when(~c["regex_found"], said("Domain_NoRegexCandidatesFound_OnAnyPage", "Canonical_NoRegexCandidatesFound"))
        .when(~c["llm_called"], said("LLM_NotCalled_DespiteRegexCandidates_ForDomain", "LLM_NoInput_NoRegexCandidates"))
        .when(c["llm_error"], said("LLM_Processing_Error_Encountered_For_Domain", "LLM_Processing_Error_AllAttempts"))
        .when(c["n_raw"] == 0, said("LLM_Output_NoRawNumbersFound_ForDomain", "LLM_Output_NoNumbersFound_AllAttempts"))
        .otherwise(said("LLM_Output_RawNumbersFound_NoneConsolidated_ForDomain", "LLM_Output_NumbersFound_NoneRelevant_AllAttempts")))


def domain_journey(pages: DataFrame, site: str, at: str) -> DataFrame:
    """Per site: pages, the last page's status unless an earlier one was better (the last success, else the last that is no
    error, else the last), whether any page had candidates, the least company name. pages: status, regex_found, company."""
    rank = F.when(F.col("status") == "Success", 2).when(~F.col("status").rlike("^Error"), 1).otherwise(0)
    return pages.groupBy(site).agg(
        F.count(F.lit(1)).alias("pages"), F.max_by("status", F.struct(rank, F.col(at))).alias("status"), F.bool_or("regex_found").alias("regex_found"), F.min("company").alias("company"))


def workers(rows: DataFrame, worker: str, now: Column, *, stalled_after: int, most: int = 10) -> tuple[DataFrame, DataFrame]:
    """One row of counts (workers, completed, running, stalled) and the `most` running workers that have been silent
    longest. rows: (worker, done, expected, last_seen as a number of seconds)."""
    w = rows.withColumn("age", now - F.col("last_seen"))
    complete = F.col("done") >= F.col("expected")
    counts = w.agg(
        F.count(F.lit(1)).alias("workers"), F.count_if(complete).alias("completed"), F.count_if(~complete & (F.col("age") <= stalled_after)).alias("running"),
        F.count_if(~complete & (F.col("age") > stalled_after)).alias("stalled"))
    return counts, w.where(~complete).orderBy(F.desc("age"), worker).limit(most).select(worker, "done", "expected", "age")
