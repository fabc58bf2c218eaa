"""One callable ``(spark, sf_dir) -> DataFrame`` per operator, over whole tables."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.catalog import inputs
from promptmill.catalog.inputs import EOS, table
from promptmill.functions import chat, images, rewards, templates, text
from promptmill.operators import (
    cleaning,
    instructions,
    schedule,
    scoring,
    vision,
)
from promptmill.plans import recipes
from promptmill.sources import tables
from promptmill.sources.images import bare_path
from promptmill.sources.department_csv import DEPARTMENTS, attach_department
from promptmill.sinks import writers
from promptmill.operators import profile
from promptmill.streaming import exactly_once, group_state, streams, windows
from promptmill.workspace import fresh_dir, materialize, prepare_session, touch

CUSTOM_TEMPLATE = "Q({1}): {0}\n{{json}} 100%s\nA: {2} / {0}"
CLEANING = cleaning.CleaningOptions(max_length=1000)
REWARD_NAMES = rewards.default_rewards().names()


# --- instruction text -------------------------------------------------------


def format_instruction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.instruction_rows(spark, sf_dir)
    options = instructions.InstructionOptions(eos=EOS)
    return instructions.format_instructions(rows, options).select("conv_id", "turn", "text")


def format_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.turns_with_reply(spark, sf_dir).select(
        "conv_id", "turn", F.col("question").alias("input"), F.col("answer").alias("output")
    )
    return instructions.format_qa(rows, EOS).select("conv_id", "turn", "text")


def format_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.instruction_rows(spark, sf_dir)
    options = instructions.InstructionOptions(template=CUSTOM_TEMPLATE)
    return instructions.format_instructions(rows, options).select("conv_id", "turn", "text")


def format_null_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unanswered turns rendered with the word None, as compatible output does."""
    rows = inputs.turns_with_reply(spark, sf_dir).select(
        "conv_id",
        "turn",
        F.col("question").alias("instruction"),
        F.lit(None).cast("string").alias("input"),
        F.col("answer").alias("output"),
    )
    options = instructions.InstructionOptions(compat=True)
    return instructions.format_instructions(rows, options).select("conv_id", "turn", "text")


def inference_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.instruction_rows(spark, sf_dir)
    prompt = templates.build_inference_prompt(F.col("instruction"), F.col("input"))
    return rows.select("conv_id", "turn", prompt.alias("prompt"))


def select_text_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return instructions.select_text_field(format_qa(spark, sf_dir))


def response_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses out of rendered text; texts without the marker stay as they are."""
    docs = table(spark, sf_dir, "documents")
    rendered = templates.format_instruction_prompt(
        F.col("source"), F.col("lang"), F.concat(F.lit(" \n"), F.col("text"), F.lit("\n"))
    )
    decoded = F.when(F.col("lang") == "en", rendered).otherwise(
        F.concat(F.lit(" "), F.col("text"))
    )
    return docs.select("doc_id", text.extract_response(decoded).alias("response"))


def map_batched(spark: SparkSession, sf_dir: str) -> DataFrame:

    def measure(batch: dict[str, list]) -> dict[str, list]:
        return {
            "n_words": [len(t.split()) for t in batch["text"]],
            "lang": [lang.upper() for lang in batch["lang"]],
        }

    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    mapped = instructions.map_batched(docs, measure, "n_words bigint, lang string")
    return mapped.select("doc_id", "lang", "n_words")


def preview_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return instructions.preview_first(
        docs, ["doc_id"], doc_id=F.col("doc_id"), preview=text.preview_text(F.col("text"))
    )


# --- cleaning ---------------------------------------------------------------


def _labelled(spark: SparkSession, sf_dir: str, options=CLEANING) -> DataFrame:
    picked = cleaning.pick_qa_columns(inputs.raw_qa(spark, sf_dir))
    return cleaning.label_qa(picked, options)


def clean_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = cleaning.pick_qa_columns(inputs.raw_qa(spark, sf_dir))
    return cleaning.clean_qa(picked, CLEANING, ["conv_id", "turn"])


def clean_qa_compatible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing cells kept as the word nan."""
    picked = cleaning.pick_qa_columns(inputs.raw_qa(spark, sf_dir))
    options = cleaning.CleaningOptions(max_length=1000, compat=True)
    return cleaning.clean_qa(picked, options, ["conv_id", "turn"])


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir).select("conv_id", "turn", "reject_reason")


def reject_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.reject_report(_labelled(spark, sf_dir))


def kept_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.kept_count(cleaning.kept(_labelled(spark, sf_dir)))


def observed_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept rows counted while they are written, without a pass of its own."""
    kept = cleaning.kept(_labelled(spark, sf_dir)).select("conv_id", "turn", "question", "answer")
    counted, observation = cleaning.count_while_writing(kept, "kept")
    counted.write.parquet(fresh_dir(spark, "kept"))
    return spark.createDataFrame([(observation.get["n_rows"],)], "n_rows long")


def department_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("conv_id") + F.col("turn")
    labelled = _labelled(spark, sf_dir).withColumn("dept_dir", inputs.department_of(number))
    return cleaning.reject_report(labelled, ["dept_dir"])


def reject_subtotals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects per department, file and reason with subtotals and a total, in one rollup."""
    number = F.col("conv_id") + F.col("turn")
    labelled = _labelled(spark, sf_dir).withColumn("dept_dir", inputs.department_of(number))
    labelled = labelled.withColumn("file", F.concat("dept_dir", F.lit("/part-"), (F.col("conv_id") % 3).cast("string"), F.lit(".csv")))
    return cleaning.reject_rollup(labelled, ["dept_dir", "file"])


def alias_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question and answer found by header, which differs from row to row."""
    kind = F.col("conv_id") % 4
    headers = [
        ["id", "ask", "response"], ["问题", "question", "回答"], ["answer", "问题", "ask"],
        ["id", "title", "body"],
    ]
    header = F.get(
        F.array(*[F.array(*[F.lit(name) for name in names]) for names in headers]),
        kind.cast("int"),
    )
    rows = inputs.turns_with_reply(spark, sf_dir).select(
        "conv_id",
        "turn",
        header.alias("header"),
        F.array(F.col("conv_id").cast("string"), "question", "answer").alias("fields"),
        F.lit(0).alias("shift"),
    )
    picked = cleaning.pick_qa_cells(rows)
    return picked.select("conv_id", "turn", "question_raw", "answer_raw", "answer_known")


def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("origin"), F.col("doc_id").alias("id"), "text", "lang"
    )
    benchmark = table(spark, sf_dir, "benchmark").select(
        F.lit("benchmark").alias("origin"), F.col("item_id").alias("id"), "text"
    )
    pages = table(spark, sf_dir, "pages").select(
        F.lit("pages").alias("origin"), F.col("page_id").alias("id"), F.col("html").alias("text")
    )
    return cleaning.union_sources(documents, benchmark, pages)


def extra_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files whose headers differ beyond the known columns, united; their extra columns read from a VARIANT."""
    docs = table(spark, sf_dir, "documents")
    layouts = {
        "a": (F.col("doc_id") % 3 == 0, ["doc_id", "text", "lang"]),
        "b": (F.col("doc_id") % 3 == 1, ["doc_id", "text", "source", "n_chars"]),
        "c": (F.col("doc_id") % 3 == 2, ["text", "doc_id"]),
    }
    root = fresh_dir(spark, "extra-columns")
    parts = []
    for name, (rows, columns) in layouts.items():
        docs.where(rows).select(*columns).withColumn("text", F.regexp_replace("text", "[\\r\\n]", " ")).write.option(
            "header", True
        ).csv(f"{root}/{name}")
        parts.append(spark.read.options(header=True, inferSchema=True).csv(f"{root}/{name}"))
    united = cleaning.union_with_extras(parts, ["doc_id", "text"])
    return united.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.variant_get("extras", "$.lang", "string").alias("lang"),
        F.variant_get("extras", "$.source", "string").alias("source"),
        F.variant_get("extras", "$.n_chars", "long").alias("n_chars"),
    )


def department_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.substring("source", 4, 10).cast("int")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", inputs.department_of(number).alias("dept_dir")
    )
    return attach_department(docs).select("doc_id", "dept_dir", "department")


def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.table_profile(table(spark, sf_dir, "pages"))


def _planted_records(spark: SparkSession, sf_dir: str, format: str) -> tuple[DataFrame, DataFrame]:
    """Instruction rows of the documents as JSON lines or CSV; every fiftieth record is broken on purpose.

    A broken JSON record is cut short; a broken CSV record has a key that is no number.
    """
    docs = table(spark, sf_dir, "documents")
    planted = F.col("doc_id") % 50 == 0
    if format == "json":
        record = F.to_json(F.struct("doc_id", F.col("source").alias("instruction"), F.col("lang").alias("input"), F.col("text").alias("output")))
        line = F.when(planted, F.concat(F.substring(record, 1, 40), F.lit(' "cut'))).otherwise(record)
    else:
        def quoted(column):
            return F.concat(F.lit('"'), F.regexp_replace(F.coalesce(column, F.lit("")), '"', '""'), F.lit('"'))

        key = F.when(planted, F.concat(F.col("doc_id").cast("string"), F.lit("x"))).otherwise(F.col("doc_id").cast("string"))
        line = F.concat_ws(",", key, quoted(F.col("source")), quoted(F.col("lang")), quoted(F.regexp_replace("text", "[\\r\\n]", " ")))
    path = fresh_dir(spark, f"planted-{format}")
    docs.select(line.alias("value")).write.text(path)
    return tables.read_checked(spark, path, format, f"doc_id long, {tables.INSTRUCTION_SCHEMA}", header=False)


def record_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record of JSON-lines and CSV files with planted broken ones: kept, or rejected with its reason."""
    out = None
    for format, key in (("json", r'^\{"doc_id":([0-9]+)'), ("csv", "^([0-9]+)")):
        good, bad = _planted_records(spark, sf_dir, format)
        kept = good.select(F.lit(format).alias("format"), "doc_id", F.lit("kept").alias("status"))
        rejected = bad.select(
            F.lit(format).alias("format"), F.regexp_extract("record", key, 1).cast("bigint").alias("doc_id"), F.col("reject_reason").alias("status")
        )
        both = kept.unionByName(rejected)
        out = both if out is None else out.unionByName(both)
    return out


def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact counts and lengths of every column of the documents, from the one-pass profile."""
    return profile.column_profile(table(spark, sf_dir, "documents")).select(*profile.EXACT)


# --- reasoning --------------------------------------------------------------


def hash_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.solutions(spark, sf_dir)
    return rows.select("o_orderkey", text.extract_hash_answer(F.col("answer")).alias("answer"))


def xml_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.completion_rows(spark, sf_dir)
    return rows.select("gen_id", text.extract_xml_answer(F.col("completion")).alias("extracted"))


def xml_cot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.pairs(spark, sf_dir)
    layout = templates.format_xml_cot(F.col("question"), F.col("answer"))
    return rows.select("conv_id", "turn", layout.alias("text"))


def chat_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompts = scoring.build_prompts(inputs.prompt_rows(spark, sf_dir))
    return prompts.select(
        "prompt_id",
        F.col("prompt")[0]["role"].alias("first_role"),
        text.first_message_content(F.col("prompt")).alias("system_text"),
        F.col("prompt")[1]["role"].alias("last_role"),
        text.last_message_content(F.col("prompt")).alias("question_text"),
        "answer",
    )


def chat_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", chat.build_chat_text(F.col("text")).alias("chat"))


def chat_exchange(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user and an assistant message rendered without opening a further one."""
    messages = F.array(
        chat.message("user", F.col("question")), chat.message("assistant", F.col("answer"))
    )
    return inputs.pairs(spark, sf_dir).select(
        "conv_id", "turn", chat.render_chat_text(messages).alias("chat")
    )


def attach_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompts = scoring.build_prompts(inputs.prompt_rows(spark, sf_dir))
    joined = scoring.attach_gold(inputs.completion_rows(spark, sf_dir), prompts)
    return joined.select("gen_id", "prompt_id", "gold")


def _scored(spark: SparkSession, sf_dir: str, reward_list=None, weights=None) -> DataFrame:
    prompts = scoring.build_prompts(inputs.prompt_rows(spark, sf_dir))
    return recipes.score_reasoning(
        inputs.completion_rows(spark, sf_dir), prompts, reward_list, weights
    )


def reward_correctness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("gen_id", "reward_correctness")


def reward_integer(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = text.extract_xml_answer(F.col("completion"))
    rows = inputs.completion_rows(spark, sf_dir)
    return rows.select("gen_id", rewards.reward_integer(extracted).alias("reward_integer"))


def reward_strict_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = rewards.reward_strict_format(F.col("completion")).alias("reward_strict_format")
    return inputs.completion_rows(spark, sf_dir).select("gen_id", score)


def reward_soft_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = rewards.reward_soft_format(F.col("completion")).alias("reward_soft_format")
    return inputs.completion_rows(spark, sf_dir).select("gen_id", score)


def reward_xml_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = rewards.reward_xml_count(F.col("completion")).alias("reward_xml_count")
    return inputs.completion_rows(spark, sf_dir).select("gen_id", score)


def reward_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("gen_id", *REWARD_NAMES, "reward_total")


def reward_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = {"reward_correctness": 0.5, "reward_integer": 2.0}
    return _scored(spark, sf_dir, weights=weights).select("gen_id", "reward_total")


def reward_python(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's list-based Python reward added to the built-in ones."""

    def brevity(prompts, completions, answer, status, **kwargs):
        return [
            0.25 if len(c[0]["content"]) < 40 and s != "P" else 0.0
            for c, s in zip(completions, status)
        ]

    reward_list = rewards.default_rewards().with_reward(
        "reward_brevity", rewards.python_reward(brevity, {"status": F.col("status")})
    )
    return _scored(spark, sf_dir, reward_list).select("gen_id", "reward_brevity", "reward_total")


def reward_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = scoring.reward_by_function(
        _scored(spark, sf_dir), [*REWARD_NAMES, "reward_total"], ["status"]
    )
    return means.withColumn("mean_reward", F.round("mean_reward", 9) + F.lit(0.0))


def group_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = scoring.group_reward_stats(_scored(spark, sf_dir))
    return stats.withColumns(
        {
            name: F.round(name, 9) + F.lit(0.0)
            for name in ("mean_reward", "std_reward", "max_reward")
        }
    )


def advantages(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Statistics and rows both read the scores; completions are scored once for them.
    scored = _scored(spark, sf_dir).select("gen_id", "prompt_id", "reward_total")
    result = scoring.group_advantage(materialize(scored, "scores"))
    return result.select(
        "gen_id", "prompt_id", (F.round("advantage", 6) + F.lit(0.0)).alias("advantage")
    )


def reward_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completions that come as lists of messages; the first one counts."""
    rows = inputs.completion_rows(spark, sf_dir)
    spoken = chat.message("assistant", F.col("completion"))
    rows = rows.withColumn("completion", F.array(spoken, chat.message("user", F.lit("thanks"))))
    prompts = scoring.build_prompts(inputs.prompt_rows(spark, sf_dir))
    return recipes.score_reasoning(rows, prompts).select("gen_id", *REWARD_NAMES, "reward_total")


def best_of_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = scoring.best_of_n(_scored(spark, sf_dir), "gen_id", keep=("completion",))
    return best.select("prompt_id", "gen_id", "completion", "reward_total")


# --- order, budgets, tokens -------------------------------------------------


def shuffle_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return schedule.seeded_rank(docs, ["doc_id"])


def shuffle_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return schedule.with_place(schedule.seeded_shuffle(docs, ["doc_id"]))


def sample_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return schedule.sample_budget(docs, ["doc_id"], schedule.ScheduleOptions(max_steps=60))


def schedule_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    options = schedule.ScheduleOptions(epochs=3, devices=2)
    return schedule.training_schedule(docs, ["doc_id"], options)


def schedule_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schedule of ``schedule_epochs`` written in shards of eight steps, read again from step 20 on."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    options = schedule.ScheduleOptions(epochs=3, devices=2)
    path = fresh_dir(spark, "schedule-shards")
    writers.write_schedule_shards(schedule.training_schedule(docs, ["doc_id"], options), path, 8)
    return writers.read_from_step(spark, path, 20)


def schedule_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A step limit wins over the epochs; it covers several epochs of a small table."""
    rows = table(spark, sf_dir, "labels").select("doc_id")
    options = schedule.ScheduleOptions(epochs=3, max_steps=240)
    return schedule.training_schedule(rows, ["doc_id"], options)


def token_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    limited = schedule.limit_tokens(docs, "text", 512)
    return limited.select(
        "doc_id",
        F.col("n_tokens").cast("long").alias("n_tokens"),
        F.size("tokens").cast("long").alias("n_kept"),
        F.array_join("tokens", " ").alias("kept_text"),
    )


def prompt_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.pairs(spark, sf_dir)
    limited = schedule.limit_prompt_completion(rows, "question", "answer", 64, 256)
    return limited.select(
        "conv_id",
        "turn",
        F.col("prompt_tokens").cast("long").alias("prompt_tokens"),
        F.col("completion_tokens").cast("long").alias("completion_tokens"),
        "fits",
    )


def _token_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tokens of every document; long documents span several blocks."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.whitespace_tokens(F.col("text")).alias("tokens"))


def _counts(tokens: DataFrame) -> DataFrame:
    return tokens.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"))


def _packed(counts: DataFrame) -> DataFrame:
    return schedule.pack_sequences(counts, ["doc_id"], block_length=2048)


def pack_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Packing reads its input twice; the texts are split once for it.
    counts = materialize(_counts(_token_rows(spark, sf_dir)), "token-counts")
    return _packed(counts).select(
        "doc_id", "block_id", "block_offset", "token_from", "token_count"
    )


def packed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = materialize(_token_rows(spark, sf_dir), "tokens")
    placed = _packed(_counts(tokens)).join(tokens, "doc_id")
    return schedule.assemble_blocks(placed).select(
        "block_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.array_join("tokens", " ").alias("block_text"),
    )


# --- vision -----------------------------------------------------------------

VISION = vision.VisionOptions(base_dir="/store/")


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vision.normalize_manifest(inputs.manifest_rows(spark, sf_dir), VISION)


def vision_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = inputs.picture_rows(spark, sf_dir).select("path")
    records = vision.vision_records(_manifest(spark, sf_dir), files, keep=("id",))
    user, reply = F.col("messages")[0], F.col("messages")[1]
    return records.select(
        "id",
        user["role"].alias("user_role"),
        F.array_join(F.transform(user["content"], lambda p: p["type"]), ",").alias("user_types"),
        user["content"][0]["text"].alias("user_text"),
        user["content"][1]["image"]["origin"].alias("image_origin"),
        reply["role"].alias("reply_role"),
        reply["content"][0]["text"].alias("reply_text"),
    )


def vision_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of decodable pictures with their pixels in RGB order."""
    pictures = inputs.picture_rows(spark, sf_dir)
    records = vision.vision_records(
        _manifest(spark, sf_dir), images=pictures, keep=("id",), with_pixels=True
    )
    image = F.col("messages")[0]["content"][1]["image"]
    return records.select(
        "id",
        image["origin"].alias("origin"),
        image["nChannels"].cast("long").alias("n_channels"),
        F.lower(F.hex(image["data"])).alias("pixels"),
    )


def to_rgb(spark: SparkSession, sf_dir: str) -> DataFrame:
    pictures = vision.require_decodable_image(inputs.picture_rows(spark, sf_dir))
    rgb = images.to_rgb(F.col("image"))
    return pictures.select("doc_id", F.lower(F.hex(rgb["data"])).alias("pixels"))


def vision_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    messages = chat.build_vision_inference_messages(F.col("text"))
    return docs.select("doc_id", chat.render_vision_chat_text(messages).alias("chat"))


def image_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = inputs.picture_rows(spark, sf_dir).select("path")
    manifest = vision.require_image_path(_manifest(spark, sf_dir))
    return vision.require_image_exists(manifest, files).select("id", "image_path")


def image_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = inputs.picture_rows(spark, sf_dir).select("path")
    manifest = vision.require_image_path(_manifest(spark, sf_dir))
    return vision.without_image(manifest, files).select("id", "image_path")


def vision_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    pictures = inputs.picture_rows(spark, sf_dir)
    labelled = vision.label_manifest(
        _manifest(spark, sf_dir), pictures.select("path"), pictures.select("path", "image")
    )
    return labelled.select("id", "reject_reason")


def image_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One picture key in two buckets, one of which lacks most pictures."""
    key = F.concat(F.lit("//pictures/./"), F.col("doc_id").cast("string"), F.lit(".png"))
    bucket = F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b")
    rows = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("lang").alias("prompt"),
        F.col("source").alias("response"),
        F.when(bucket == "a", F.concat(F.lit("s3a://a"), key)).otherwise(key).alias("image"),
    )
    labels = table(spark, sf_dir, "labels")
    listed = labels.select(F.concat(F.lit("s3a://a"), key).alias("path")).union(
        labels.where(F.col("doc_id") % 3 == 0).select(F.concat(F.lit("s3a://b"), key))
    )
    options = vision.VisionOptions(base_dir="s3a://b/else")
    manifest = vision.normalize_manifest(rows, options)
    labelled = vision.label_manifest(manifest, listed.select(bare_path(F.col("path")).alias("path")))
    return labelled.select("id", "image_path", "reject_reason")


# --- files, sinks, streams --------------------------------------------------


#: How each department's files are written: encoding and the name of a column beside the pair.
#: The fourth has a character that GBK lacks, the fifth a byte no tried encoding has, the last no folder.
CSV_LAYOUTS = (
    ("UTF-8", "备注"), ("UTF-8", "note"), ("GBK", "备注"), ("GB18030", "备注㐀"), ("ISO-8859-1", "ÿ"), None,
)


def _department_files(spark: SparkSession, sf_dir: str) -> recipes.MedicalResult:
    """Pairs written as department folders of CSV files, then read and cleaned."""
    folder = fresh_dir(spark, "departments")
    pairs = inputs.turns_with_reply(spark, sf_dir).withColumn(
        "number", (F.col("conv_id") + F.col("turn")) % len(DEPARTMENTS)
    )
    before = spark.conf.get("spark.sql.legacy.javaCharsets")
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    try:
        for number, (name, layout) in enumerate(zip(DEPARTMENTS, CSV_LAYOUTS)):
            if layout is None:
                continue
            encoding, note = layout
            answer = "response" if encoding == "ISO-8859-1" else "回答"
            said = [F.col("question"), F.col("answer")]
            if encoding == "GBK":  # it lacks some accented letters of the given texts
                said = [F.regexp_replace(column, r"[^\x00-\x7F]", "字") for column in said]
            own = pairs.where(F.col("number") == number).select(
                "conv_id", said[0].alias("ask"), said[1].alias(answer), F.lit("-").alias(note)
            )
            own.write.options(
                header=True, escape='"', encoding=encoding,
                ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
            ).csv(f"{folder}/{name}")
    finally:
        spark.conf.set("spark.sql.legacy.javaCharsets", before)
    first = f"{folder}/{next(iter(DEPARTMENTS))}"
    touch(spark, f"{first}/_left.csv", f"{first}/.out.csv", f"{first}/none.csv", f"{first}/more.csv/part.csv")
    options = recipes.MedicalOptions(data_dir=folder, eos=EOS, cleaning=CLEANING)
    return recipes.prepare_medical(spark, options)


def decode_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _department_files(spark, sf_dir).labelled.select(
        F.col("department"), "encoding", "question", "answer", "reject_reason"
    )


def file_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of the files, and of the folders that are not there."""
    result = _department_files(spark, sf_dir)
    name = F.when(F.col("path").contains("/part-"), "part").otherwise(F.regexp_extract("path", "[^/]+$", 0))
    files = result.files.select("dept_dir", name.alias("name"), "encoding", "reject_reason").distinct()
    missing = [(folder, None, None, "missing_folder") for folder in result.missing_folders]
    return files.union(spark.createDataFrame(missing, files.schema))


def _written(spark: SparkSession, path: str, partition: str) -> list[str]:
    """The values of a partition column in files just written; folders, so they are few."""
    found = spark.read.parquet(path).select(partition).distinct()
    return sorted(str(row[0]) for row in found.collect())


def training_set_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written with one folder per split, read back split by split."""
    path = fresh_dir(spark, "training-set")
    docs = table(spark, sf_dir, "documents").select(
        F.col("source").alias("instruction"),
        F.col("doc_id").cast("string").alias("input"),
        F.col("text").alias("output"),
        F.col("lang").alias("split"),
    )
    writers.write_training_set(instructions.format_instructions(docs), path)
    parts = [
        tables.read_instructions(spark, path, split).withColumn("split", F.lit(split))
        for split in _written(spark, path, "split")
    ]
    return cleaning.union_sources(*parts)


def prompt_set_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Solutions by subset and split, read to prompts, written as JSON lines, read back."""
    source, target = fresh_dir(spark, "qa"), fresh_dir(spark, "prompt-set")
    rows = inputs.solutions(spark, sf_dir).withColumn("split", F.lit("train"))
    rows.write.partitionBy("subset", "split").parquet(source)
    schema = f"o_orderkey long, {tables.QA_SCHEMA}"
    subsets = [
        scoring.build_prompts(tables.read_qa_subset(spark, source, subset, schema=schema))
        .withColumn("subset", F.lit(subset))
        for subset in _written(spark, source, "subset")
    ]
    prompts = cleaning.union_sources(*subsets)
    writers.write_prompt_set(prompts, target, format="json")
    return (
        spark.read.schema(prompts.schema)
        .json(target)
        .select("o_orderkey", "subset", F.col("prompt")[1]["content"].alias("asked"), "answer")
    )


def vision_set_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "vision-set")
    files = inputs.picture_rows(spark, sf_dir).select("path")
    writers.write_vision_set(
        vision.vision_records(_manifest(spark, sf_dir), files, keep=("id",)), path
    )
    user = F.col("messages")[0]["content"]
    return spark.read.parquet(path).select(
        "id", user[0]["text"].alias("user_text"), user[1]["image"]["origin"].alias("image_origin")
    )


def _vision_folder(spark: SparkSession, sf_dir: str) -> recipes.VisionResult:
    """A manifest as CSV and pictures as PNG files, read and prepared."""
    folder = fresh_dir(spark, "vision")
    inputs.write_pictures(spark, sf_dir, f"{folder}/pictures")
    path = F.concat(F.lit("pictures/./"), F.col("doc_id").cast("string"), F.lit(".png"))
    rows = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.concat(F.lit('say "'), "lang", F.lit('", please')).alias("prompt"),
        F.when(F.col("n_chars") >= 300, path).alias("image"),
        F.when(F.col("lang") != "de", F.col("source")).alias("response"),
    )
    rows.write.options(header=True, escape='"').csv(f"{folder}/manifest")
    options = vision.VisionOptions(base_dir=folder)
    return recipes.prepare_vision(
        spark, f"{folder}/manifest", f"{folder}/pictures", options, with_pixels=True
    )


def vision_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, reply = F.col("messages")[0]["content"], F.col("messages")[1]["content"]
    image = user[1]["image"]
    return _vision_folder(spark, sf_dir).records.select(
        F.regexp_extract(image["origin"], r"(\d+)\.png$", 1).cast("long").alias("id"),
        user[0]["text"].alias("user_text"),
        reply[0]["text"].alias("reply_text"),
        F.lower(F.hex(image["data"])).alias("pixels"),
    )


def vision_file_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = _vision_folder(spark, sf_dir).labelled
    return labelled.select(F.col("id").cast("long").alias("id"), "reject_reason")


def reject_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "rejects")
    writers.write_rejects(
        _labelled(spark, sf_dir).select("conv_id", "turn", "reject_reason"), path
    )
    return spark.read.parquet(path).select("conv_id", "turn", "reject_reason")


def missing_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null and NaN cells of a floating point column, and null ones of a text column (every 7th price NaN, 11th null, 5th priority null)."""
    orders = table(spark, sf_dir, "orders")
    price = (
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(float("nan")))
        .when(F.col("o_orderkey") % 11 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("o_totalprice").cast("double"))
    )
    comment = F.when(F.col("o_orderkey") % 5 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority"))
    return orders.select(
        "o_orderkey",
        text.is_missing(price, floating=True).alias("price_missing"),
        text.is_missing(comment).alias("comment_missing"),
    )


def format_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging is idempotent: formatting a formatted table leaves it as it is."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("instruction"), F.col("lang").alias("input"), F.col("text").alias("output")
    )
    once = instructions.format_instructions(docs)
    return instructions.format_instructions(once).select("doc_id", "text")


def stream_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    arriving = streams.read_arriving(spark, f"{sf_dir}/documents.parquet*", docs.schema).select(
        "doc_id",
        F.col("source").alias("instruction"),
        F.col("lang").alias("input"),
        F.col("text").alias("output"),
    )
    result = streams.run_to_end(
        streams.stream_format,
        arriving,
        fresh_dir(spark, "stream-format"),
        fresh_dir(spark, "stream-format-state"),
    )
    return result.select("doc_id", "text")


def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completions arriving as a stream, scored against the static prompts."""
    rows = inputs.completion_rows(spark, sf_dir)
    landed = fresh_dir(spark, "completions")
    rows.write.parquet(landed)
    prompts = scoring.build_prompts(inputs.prompt_rows(spark, sf_dir))
    result = streams.run_to_end(
        lambda arriving: streams.stream_score(arriving, prompts),
        streams.read_arriving(spark, landed, rows.schema),
        fresh_dir(spark, "stream-score"),
        fresh_dir(spark, "stream-score-state"),
    )
    return result.select("gen_id", *REWARD_NAMES, "reward_total")


def stream_advantages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completions arriving in four parts in shuffled order; each prompt's advantages once its group is complete.

    Every completion carries the size of its group (the generations asked for
    its prompt); a group that stays incomplete is emitted when its timer fires.
    """
    rows = inputs.completion_rows(spark, sf_dir)
    asked = rows.groupBy("prompt_id").agg(F.count("*").alias("n_generations"))
    landed = fresh_dir(spark, "arriving-completions")
    rows.join(asked, "prompt_id").repartition(4, F.xxhash64("gen_id")).write.parquet(landed)
    arriving = streams.read_arriving(spark, landed, spark.read.parquet(landed).schema, maxFilesPerTrigger=1)
    prompts = scoring.build_prompts(inputs.prompt_rows(spark, sf_dir))
    result = streams.run_to_end(
        lambda batch: group_state.stream_advantages(streams.stream_score(batch, prompts)),
        arriving,
        fresh_dir(spark, "stream-advantages"),
        fresh_dir(spark, "stream-advantages-state"),
    )
    return result.select("gen_id", "prompt_id", (F.round("advantage", 6) + F.lit(0.0)).alias("advantage"))


def _split_stream(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Question and answer rows arriving in four parts; samples and rejects written exactly once."""
    landed = fresh_dir(spark, "arriving-qa")
    inputs.raw_qa(spark, sf_dir).repartition(4, F.xxhash64("conv_id", "turn")).write.parquet(landed)
    arriving = streams.read_arriving(spark, landed, spark.read.parquet(landed).schema, maxFilesPerTrigger=1)

    def label(batch: DataFrame) -> DataFrame:
        labelled = cleaning.label_qa(cleaning.pick_qa_columns(batch), CLEANING)
        return labelled.select("conv_id", "turn", "question", "answer", "reject_reason")

    return exactly_once.run_split_stream(
        label, arriving, fresh_dir(spark, "stream-samples"), fresh_dir(spark, "stream-rejects"), fresh_dir(spark, "stream-split-state")
    )


def stream_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples, _ = _split_stream(spark, sf_dir)
    return samples.select(
        F.lit(cleaning.MEDICAL_INSTRUCTION).alias("instruction"), F.col("question").alias("input"), F.col("answer").alias("output"), "conv_id", "turn"
    )


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejects = _split_stream(spark, sf_dir)
    return rejects.select("conv_id", "turn", "reject_reason")


#: Completions of one training step: order keys are dealt in runs of 32; logging every ten steps.
STEP_KEYS, LOGGING_STEPS = 32, 10


def stream_reward_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reward means per logging window while scored completions arrive, four parts in any order.

    The watermark's delay spans all steps of the landed rows, as the parts may
    come in any order; windows stay in the state store until it passes them.
    """
    rows = inputs.completion_rows(spark, sf_dir).withColumn("step", F.col("gen_id").cast("bigint") / STEP_KEYS)
    rows = rows.withColumn("step", F.floor("step"))
    landed = fresh_dir(spark, "arriving-steps")
    rows.repartition(4, F.xxhash64("gen_id")).write.parquet(landed)
    span = spark.read.parquet(landed).agg(F.max("step") - F.min("step") + 1).first()[0] or 1
    arriving = streams.read_arriving(spark, landed, spark.read.parquet(landed).schema, maxFilesPerTrigger=1)
    prompts = scoring.build_prompts(inputs.prompt_rows(spark, sf_dir))
    names = [*REWARD_NAMES, "reward_total"]
    means = windows.window_means(streams.stream_score(arriving, prompts), names, "step", LOGGING_STEPS, int(span))
    found = windows.run_window_means(means, fresh_dir(spark, "reward-windows"), fresh_dir(spark, "reward-windows-state"))
    long = found.unpivot(["logging_step"], names, "reward_name", "mean_reward")
    return long.select("logging_step", "reward_name", (F.round("mean_reward", 9) + F.lit(0.0)).alias("mean_reward"))


def _prepared(query):
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare_session(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {
    query.__name__: _prepared(query)
    for query in (
        format_instruction, format_qa, format_custom, format_null_cells, inference_prompt,
        select_text_field, response_text, map_batched, preview_first,
        clean_qa, clean_qa_compatible, reject_reasons, reject_report, kept_count,
        observed_count, department_rejects, reject_subtotals,
        alias_columns, union_sources, extra_columns, department_names, table_profile, column_profile, record_rejects,
        hash_answer, xml_answer, xml_cot, chat_prompt, chat_text, chat_exchange, attach_gold,
        reward_correctness, reward_integer, reward_strict_format, reward_soft_format,
        reward_xml_count, reward_total, reward_weighted, reward_python, reward_means,
        group_stats, advantages, reward_messages, best_of_n,
        shuffle_order, shuffle_sorted, sample_budget, schedule_epochs, schedule_resume, schedule_steps,
        token_limit, prompt_limit, pack_blocks, packed_text,
        vision_records, vision_pixels, to_rgb, vision_inference, image_exists, image_missing,
        vision_rejects, image_stores, vision_files, vision_file_rejects,
        decode_csv, file_rejects, training_set_files, prompt_set_files, vision_set_files, reject_files,
        missing_cells, format_twice, stream_format, stream_score, stream_advantages, stream_samples, stream_rejects, stream_reward_windows,
    )
}
