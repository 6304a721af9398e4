"""What models are asked about a company on the way from its texts to a pitch: a template file, inputs and an answer's fields a task."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlens.functions.text import blank_to_null, first_words, report_cell
from firmlens.operators import inference
from firmlens.shared import find_package, open_store, written

#: Columns of a partner's row, in the order of the partner table.
PARTNER_COLUMNS = (
    "Company Name", "Industry", "Industry Category", "Products/Services Offered", "USP (Unique Selling Proposition) / Key Selling Points", "Customer Target Segments",
    "Customer Target Segments Category", "Business Model", "Business Model Category", "Company Size Indicators", "Company Size Category", "Innovation Level Indicators",
    "Geographic Reach", "Geographic Reach Category", "Website", "Email", "Phone", "Source Document Section/Notes", "Is Successful Partner", "Partner_Targets_B2B",
    "Partner_Target_Audience_Size_Over_1000", "Targets_Specific_Industry_Type", "Is_Startup", "Is_AI_Software", "Is_Innovative_Product", "Is_Disruptive_Product", "Is_VC_Funded",
    "Is_SaaS_Software", "Is_Complex_Solution", "Is_Investment_Product", "Avg Leads Per Day", "Rank (1-47)",
)
TEMPLATES = Path(__file__).resolve().parents[1] / "prompts"
#: Bytes that templates may have in all: they are settings, read by the driver.
TEMPLATE_BYTES = 1 << 20


@dataclass(frozen=True)
class Task:
    """inputs: the template's marks and the columns that fill them, the first of which must not be blank; most_chars: of a text
    no more is sent."""

    inputs: Mapping[str, str]
    answer: str
    most_chars: int = 20_000
    finish: Mapping[str, Callable[[Column], Column]] = field(default_factory=dict)


def yes_no(c: Column) -> Column:
    """Yes, No or Unknown."""
    said = F.initcap(F.trim(c))
    return F.when(said.isin("Yes", "No"), said).otherwise("Unknown")


_ATTRIBUTES = (
    "b2b_indicator boolean, phone_outreach_suitability boolean, target_group_size_assessment string, industry string, products_services_offered array<string>, usp_key_selling_points array<string>, customer_target_segments array<string>, "
    "business_model string, company_size_indicators_text string, company_size_category_inferred string, innovation_level_indicators_text string, website_clarity_notes string"
)
TASKS = {
    "summary": Task({"SCRAPED_WEBSITE_TEXT_PLACEHOLDER": "text"}, "summary string, extracted_company_name_from_summary string, key_topics_mentioned array<string>"),
    "attributes": Task({"WEBSITE_SUMMARY_TEXT_PLACEHOLDER": "summary"}, _ATTRIBUTES),
    "capacity": Task({"WEBSITE_SUMMARY_TEXT_PLACEHOLDER": "summary"}, "is_b2b string, is_b2b_reason string, serves_1000_customers string, serves_1000_customers_reason string", finish={"is_b2b": yes_no, "serves_1000_customers": yes_no}),
    "pitch": Task({"TARGET_COMPANY_ATTRIBUTES_JSON_PLACEHOLDER": "attributes_json", "MATCHED_GOLDEN_PARTNER_JSON_PLACEHOLDER": "partner_json", "PREVIOUS_MATCH_RATIONALE_PLACEHOLDER": "rationale"}, "match_score string, match_rationale_features array<string>, phone_sales_line string"),
    "short_summary": Task({"INPUT_DESCRIPTION_PLACEHOLDER": "description"}, "german_summary string", finish={"german_summary": first_words}),
    "homepage": Task({"HOMEPAGE_TEXT_PLACEHOLDER": "text"}, "company_name string, summary_description string, industry string"),
    "partner_row": Task({"PARTNER_DOCS_BUNDLE": "bundle"}, "map<string,string>"),
}


def read_templates(spark: SparkSession, folder: str | None = None) -> dict[str, str]:
    """Templates by the names of their files (.txt) in a folder that Spark reads; without one the library's own, which the driver
    reads beside its code. A template without a task's marks is an error when the task runs, not here."""
    if folder is None:
        return {p.stem: p.read_text(encoding="utf-8") for p in sorted(TEMPLATES.glob("*.txt"))}
    rows = spark.read.option("pathGlobFilter", "*.txt").text(folder, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.txt$", 1).alias("name"), "value", F.octet_length("value").cast("long").alias("n"))
    if (rows.agg(F.sum("n")).first()[0] or 0) > TEMPLATE_BYTES:
        raise ValueError(f"templates of more than {TEMPLATE_BYTES} bytes in {folder}")
    return {r["name"]: r["value"] for r in rows.collect()}


def prompt_of(task: str, template: str) -> Column:
    """The template with a task's inputs in place of its marks, '' for null ones; null where the first input is blank."""
    spec = TASKS[task]
    if missing := [m for m in spec.inputs if "{{" + m + "}}" not in template]:
        raise ValueError(f"the template of {task} lacks {missing}")
    pieces = re.split(r"\{\{(\w+)\}\}", template)  # inputs are put between the pieces, so marks inside of them stay
    parts = [F.lit(p) if k % 2 == 0 else F.coalesce(F.left(F.col(spec.inputs[p]), F.lit(spec.most_chars)), F.lit("")) if p in spec.inputs else F.lit("{{" + p + "}}") for k, p in enumerate(pieces)]
    return F.when(blank_to_null(F.col(next(iter(spec.inputs.values())))).isNotNull(), F.concat(*parts))


def run_task(rows: DataFrame, task: str, templates: Mapping[str, str], cache: DataFrame, make: Callable[[], inference.Provider], **how) -> DataFrame:
    """rows with the answer's fields and <task>_status: ok, no_input, error (the provider failed) or unreadable (no such JSON).

    Equal prompts are asked once, cached answers first (inference.ask; how: its settings). Calls are written before they are
    joined back, so that none is made twice. An answer's field replaces a column of that name. Rows stay as they are,
    repeated ones too; a null or blank first input is not sent. The answer of partner_row becomes PARTNER_COLUMNS, '' where
    it has nothing, without characters that spreadsheets refuse.
    """
    spec = TASKS[task]
    asked = rows.withColumn("_prompt", prompt_of(task, templates[task])).withColumn("_sha", F.sha2(F.concat_ws("\n", F.lit(task), "_prompt"), 256))
    calls = written(inference.ask(asked.select(F.col("_prompt").alias("prompt")), cache, task, make, **how), task)
    said = inference.answers(calls, spec.answer).select(F.col("prompt_sha256").alias("_sha"), "answer", F.col("status").alias("_call"))
    out = asked.join(said, "_sha", "left")
    if spec.answer.startswith("map<"):
        fields = {c: report_cell(F.coalesce(F.col("answer")[F.lit(c)], F.lit(""))) for c in PARTNER_COLUMNS}
    else:
        names = re.findall(r"(\w+) (?:array<string>|\w+)(?:, |$)", spec.answer)
        fields = {n: F.col(f"answer.{n}") for n in names}
        fields |= {n: F.when(F.col("answer").isNotNull(), f(fields[n])) for n, f in spec.finish.items()}
    status = F.when(F.col("_prompt").isNull(), "no_input").when(F.col("_call") != "ok", "error").when(F.col("answer").isNull(), "unreadable").otherwise("ok")
    kept = [c for c in rows.columns if c not in (*fields, f"{task}_status")]
    return out.select(*[F.col(f"`{c}`") for c in kept], *[c.alias(n) for n, c in fields.items()], status.alias(f"{task}_status"))


def attributes_json(**renamed: str) -> Column:
    """The attributes of a row as the JSON text that a pitch is written from; renamed: fields from other columns."""
    names = re.findall(r"(\w+) (?:array<string>|\w+)(?:, |$)", _ATTRIBUTES)
    return F.to_json(F.struct(*[F.col(renamed.get(n, n)).alias(n) for n in names]), {"ignoreNullFields": "false"})


def write_artifacts(calls: DataFrame, folder: str, prefix: str = "run") -> DataFrame:
    """Each call of calls (inference.CALLS) as two text files, its prompt and its answer, named by task and the prompt's digest;
    (path, bytes) of what was written. A file is seen when it is whole, and writing it again changes nothing."""
    find_package(calls.sparkSession)
    uri = folder.rstrip("/")

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_store(uri)
        fs.create_dir(path, recursive=True)
        for frame in frames:
            out = []
            for task, digest, prompt, answer in zip(*(c.to_pylist() for c in frame.columns), strict=True):
                for kind, text in (("prompt", prompt), ("response", answer)):
                    name, body = f"{prefix}_{task}_{digest[:24]}_{kind}.txt", (text or "").encode()
                    with fs.open_output_stream(f"{path}/_{name}.part", compression=None) as f:
                        f.write(body)
                    fs.move(f"{path}/_{name}.part", f"{path}/{name}")
                    out.append((f"{uri}/{name}", len(body)))
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.string()), pa.array([n for _, n in out], pa.int64())], names=["path", "bytes"])

    return written(calls.select("task", "prompt_sha256", "prompt", "response_text").mapInArrow(run, "path string, bytes long"), "artifacts")


def rule_provider() -> inference.Provider:
    """A provider without a model for these tasks: it answers from the first words of the input."""

    def answer(prompt: str) -> tuple[str, int]:
        task = prompt.partition("\n")[0].removeprefix("Task: ")
        given = prompt.partition("\nInput:\n")[2].removesuffix("\n")
        words = [w for w in re.split(r"[ \t\n\f\r]+", given) if w]
        n = len(given)
        if task == "summary":
            out: dict = {"summary": " ".join(words[:12]), "extracted_company_name_from_summary": words[0], "key_topics_mentioned": words[1:4]}
        elif task == "capacity":
            out = {"is_b2b": ("yes", " No ", "perhaps")[n % 3], "is_b2b_reason": words[0], "serves_1000_customers": ("No", "YES", None)[n % 3]}
        elif task == "attributes":
            out = {"b2b_indicator": n % 2 == 0, "industry": words[-1], "products_services_offered": words[:2]}
        elif task == "pitch":
            out = {"match_score": "High", "match_rationale_features": [], "phone_sales_line": f"Guten Tag, es geht um {json.loads(given)['industry']}."}
        elif task == "short_summary":
            out = {"german_summary": given}
        elif task == "homepage":
            out = {"company_name": words[0], "summary_description": " ".join(words[:5]), "industry": None}
        else:
            out = {"Company Name": words[0], "Industry": "\x01" + words[-1], "Other": "x"}
        return f"```json\n{json.dumps(out)}\n```", len(words)

    return answer
