"""Model tasks over the seam of `inference`: prompts, schemas, and answers brought back to the rows they are about."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlens.functions import fixed
from firmlens.operators import inference, ranking
from firmlens.shared import written

#: Answer schemas by task.
SCHEMAS = {
    "phone_classify": "array<struct<number:string,source_url:string,type:string,classification:string,is_valid:boolean,associated_person_name:string,associated_person_role:string>>",
    "phone_rerank": "ranked_numbers array<struct<number:string,type:string,priority_label:string>>, main_office_backup_number string, deprioritized_numbers array<string>, suspected_other_org_numbers array<string>",
    "partner_match": "matched_partner_id string, matched_partner_name string, match_score string, match_rationale_features array<string>",
}
PROMPTS = {
    "phone_classify": "Classify each of these phone numbers of {company} by type and class. Answer as a JSON list.\n{items}",
    "phone_rerank": "Rank these numbers of {company} for a sales call, best first. Answer as one JSON object.\n{items}",
    "partner_match": "Which of these partners fits {company}? Answer as one JSON object.\n{profile}\n{items}",
}
CLASSES = tuple(fixed.CLASS_PRIORITY)
OUTPUT_TYPES = tuple(fixed.OUTPUT_TYPES)


def drop_keys(schema: Any, keys: Sequence[str]) -> Any:
    """A JSON schema without some keys, at any depth."""
    if isinstance(schema, dict):
        return {k: drop_keys(v, keys) for k, v in schema.items() if k not in keys}
    return [drop_keys(x, keys) for x in schema] if isinstance(schema, list) else schema


def inline_references(schema: dict) -> dict:
    """A JSON schema with its $ref definitions in place and unions with null as nullable types."""
    defined = schema.get("$defs", {})

    def walk(x: Any, open_: tuple[str, ...] = ()) -> Any:
        if isinstance(x, list):
            return [walk(y, open_) for y in x]
        if not isinstance(x, dict):
            return x
        if "$ref" in x:
            name = x["$ref"].rpartition("/")[2]
            if name in open_:
                raise ValueError(f"{name} refers to itself")
            return walk(defined[name], (*open_, name))
        if "anyOf" in x and {"type": "null"} in x["anyOf"] and len(x["anyOf"]) == 2:
            other = next(y for y in x["anyOf"] if y != {"type": "null"})
            return {**walk({k: v for k, v in x.items() if k != "anyOf"}, open_), **walk(other, open_), "nullable": True}
        return {k: walk(v, open_) for k, v in x.items() if k != "$defs"}

    return walk(schema)


def chunked_items(rows: DataFrame, group: str, order: list[Column], fields: dict[str, Column], size: int, most: int | None = None) -> DataFrame:
    """(group, chunk, items): up to `size` rows as JSON lines; chunks over `most` left out."""
    from firmlens.operators.relations import chunk_jobs

    item = F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()]))
    chunked = chunk_jobs(rows.withColumns({"_item": item, "_o": F.struct(*order)}), group, [F.col("_o"), F.col("_item")], size, most)
    return chunked.groupBy(group, "chunk").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_o", "_item"))), lambda x: x["_item"]), "\n").alias("items"))


def classify_numbers(candidates: DataFrame, cache: DataFrame, make: Callable[[], inference.Provider], *, site: str, row: str, size: int = 10, workers: int | None = None) -> DataFrame:
    """candidates(row, site, number, source_url) with what the model says of each: type, classification, status.

    Sites' candidates are asked for in chunks of `size`; answers are brought back by number and URL. What comes back for no
    candidate is dropped; candidates without an answer are asked for once more, one by one; what then is still missing
    has status error, type Unknown and class Non-Business. Unknown types and classes become Unknown and Non-Business.
    """
    def ask(rows: DataFrame, n: int) -> DataFrame:
        chunks = chunked_items(rows, site, [F.col(row)], {"number": F.col("number"), "source_url": F.col("source_url")}, n)
        chunks = chunks.withColumn("prompt", inference.fill(PROMPTS["phone_classify"], {"company": F.col(site), "items": F.col("items")}))
        calls = inference.answers(inference.ask(chunks, cache, "phone_classify", make, workers=workers), SCHEMAS["phone_classify"])
        said = calls.select("prompt_sha256", F.posexplode_outer("answer").alias("at", "a")).where("a IS NOT NULL")
        outputs = said.select(F.xxhash64("prompt_sha256", "at").alias("out_id"), "a.number", "a.source_url", "a.is_valid", "a.classification", "a.type", F.col("a.associated_person_name").alias("person"), F.col("a.associated_person_role").alias("role"))
        return ranking.best_outputs(rows, outputs, row)

    rows = candidates.select(row, site, "number", "source_url")
    first = written(ask(rows, size), "classified")  # both parts of it are read: no call is made twice
    again = ask(first.where("needs_retry").select(row, site, "number", "source_url"), 1)
    done = first.where("NOT needs_retry").withColumn("tries", F.lit(1)).unionByName(again.withColumn("tries", F.lit(2)))
    missing = F.col("needs_retry")
    return done.select(
        row, site, "number", "source_url", F.when(missing, "Unknown").otherwise(ranking.coerce_enum(F.col("type"), OUTPUT_TYPES, "Unknown")).alias("type"),
        F.when(missing, "Non-Business").otherwise(ranking.coerce_enum(F.col("classification"), CLASSES, "Non-Business")).alias("classification"), F.when(missing, "error").otherwise("ok").alias("status"), "tries")


def rank_numbers(payload: DataFrame, cache: DataFrame, make: Callable[[], inference.Provider], *, site: str, workers: int | None = None) -> DataFrame:
    """payload(site, place, payload) to one ranking a site: (site, answer). A site is asked about once; equal prompts share
    a call."""
    grouped = payload.groupBy(site).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "payload"))), lambda x: x["payload"]), "\n").alias("items"))
    prompt = inference.fill(PROMPTS["phone_rerank"], {"company": F.col(site), "items": F.col("items")})
    grouped = written(grouped.select(site, prompt.alias("prompt")), "prompts")  # read thrice: the payload is made once
    calls = inference.answers(inference.ask(grouped, cache, "phone_rerank", make, workers=workers), SCHEMAS["phone_rerank"])
    return grouped.join(calls.select("prompt", "answer"), "prompt").drop("prompt")


def match_partners(shortlist: DataFrame, cache: DataFrame, make: Callable[[], inference.Provider], *, target: str, workers: int | None = None) -> DataFrame:
    """shortlist(target, place, profile, payload) to one choice a target: (target, answer)."""
    grouped = shortlist.groupBy(target).agg(F.first("profile").alias("profile"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "payload"))), lambda x: x["payload"]), "\n").alias("items"))
    prompt = inference.fill(PROMPTS["partner_match"], {"company": F.col(target), "profile": F.col("profile"), "items": F.col("items")})
    grouped = written(grouped.select(target, prompt.alias("prompt")), "prompts")  # read thrice: the shortlist is made once
    calls = inference.answers(inference.ask(grouped, cache, "partner_match", make, workers=workers), SCHEMAS["partner_match"])
    return grouped.join(calls.select("prompt", "answer"), "prompt").drop("prompt")


def rule_provider() -> inference.Provider:
    """A provider without a model for the tasks here: numbers by their last digit, the first listed partner."""

    def answer(prompt: str) -> tuple[str, int]:
        items = [json.loads(x) for x in prompt.split("\n")[1:] if x.startswith("{")]
        if prompt.startswith("Classify"):
            out = []
            for x in items:
                last = int(re.sub(r"\D", "", x["number"])[-1])
                if last == 7 and len(items) > 1 or last == 8:  # left out of long lists, or always
                    continue
                out.append({"number": x["number"], "source_url": x["source_url"], "type": ("Sales", "main office", "Fax", "?")[last % 4], "classification": ("Primary", "secondary", "?")[last % 3], "is_valid": True})
            return "Here:\n```json\n" + json.dumps(out) + "\n```", len(prompt)
        if prompt.startswith("Rank"):
            names = sorted((x["number"] for x in items), reverse=True)
            ranked = [{"number": n, "type": "", "priority_label": "Low Value" if n.endswith("3") else "High"} for n in names]
            return json.dumps({"ranked_numbers": ranked, "main_office_backup_number": names[-1], "deprioritized_numbers": [n for n in names if n.endswith("5")], "suspected_other_org_numbers": ["+00"]}), len(prompt)
        first = items[0] if items else {"partner_id": None, "name": "No suitable match found"}
        return json.dumps({"matched_partner_id": first["partner_id"], "matched_partner_name": first["name"], "match_score": "High", "match_rationale_features": ["Zielgruppe"]}), len(prompt)

    return answer

