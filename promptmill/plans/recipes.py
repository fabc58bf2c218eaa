"""The four recipes: read, clean, format; scoring for the reasoning one."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from promptmill.functions.rewards import RewardList
from promptmill.operators import cleaning, vision
from promptmill.operators.instructions import (
    InstructionOptions,
    format_instructions,
    format_qa,
    label_instructions,
)
from promptmill.operators.scoring import attach_gold, build_prompts, score_completions
from promptmill.sources.department_csv import (
    DepartmentFolders,
    attach_department,
    read_department_rows,
)
from promptmill.sources.images import read_images
from promptmill.sources.tables import read_instructions, read_manifest, read_qa_subset


@dataclass(frozen=True)
class InstructionResult:
    """``samples`` with text; ``labelled`` all rows with the reason of those left out."""

    samples: DataFrame
    labelled: DataFrame


def prepare_instructions(
    spark: SparkSession,
    path: str,
    split: str = "train",
    options: InstructionOptions = InstructionOptions(),
    format: str = "parquet",
) -> InstructionResult:
    """Instruction table with its ``text``, and all its rows with a reason for those without one.

    Fails when nothing is left.
    """
    rows = read_instructions(spark, path, split, format)
    samples = cleaning.require_non_empty(format_instructions(rows, options))
    return InstructionResult(samples, label_instructions(rows, options))


@dataclass(frozen=True)
class MedicalOptions:
    data_dir: str
    eos: str
    departments: dict[str, str] | None = None
    encoding_order: str = "utf8_first"
    template: str | None = None
    cleaning: cleaning.CleaningOptions = field(default_factory=cleaning.CleaningOptions)


@dataclass(frozen=True)
class MedicalResult:
    """``samples`` with text; ``labelled`` all rows; ``files`` verdicts; absent folders."""

    samples: DataFrame
    labelled: DataFrame
    files: DataFrame
    missing_folders: list[str]


def prepare_medical(spark: SparkSession, options: MedicalOptions) -> MedicalResult:
    """Department folders to question-answer training text.

    Each row keeps its department and file as columns beside the triple. The
    files are read and cut at once, by several jobs that write intermediate
    tables; only what follows is lazy. Fails when no sample is left.
    """
    folders = (
        DepartmentFolders(options.data_dir)
        if options.departments is None
        else DepartmentFolders(options.data_dir, dict(options.departments))
    )
    read = read_department_rows(spark, folders, options.encoding_order)
    rows = attach_department(cleaning.pick_qa_cells(read.rows), folders.departments)
    labelled = cleaning.label_qa(rows, options.cleaning).select(
        "path", "dept_dir", "department", "encoding", "question", "answer", "reject_reason"
    )
    triples = cleaning.to_canonical_triple(
        cleaning.kept(labelled), options.cleaning.instruction, ["department", "path"]
    )
    samples = cleaning.require_non_empty(
        format_qa(triples, options.eos, options.template, options.cleaning.compat)
    )
    return MedicalResult(samples, labelled, read.files, read.missing)


def prepare_reasoning(
    spark: SparkSession,
    path: str,
    subset: str = "main",
    split: str = "train",
    system_prompt: str | None = None,
    format: str = "parquet",
) -> DataFrame:
    """Question table to prompts with gold answers."""
    return build_prompts(read_qa_subset(spark, path, subset, split, format), system_prompt)


def score_reasoning(
    completions: DataFrame,
    prompts: DataFrame,
    rewards: RewardList | None = None,
    weights: dict[str, float] | None = None,
) -> DataFrame:
    """Completions scored against the prompts they answer."""
    return score_completions(attach_gold(completions, prompts), rewards, weights)


@dataclass(frozen=True)
class VisionResult:
    records: DataFrame
    labelled: DataFrame


def prepare_vision(
    spark: SparkSession,
    manifest_path: str,
    image_dir: str,
    options: vision.VisionOptions = vision.VisionOptions(),
    format: str = "csv",
    schema: str | None = None,
    with_pixels: bool = False,
) -> VisionResult:
    """Manifest and image folder to conversation records.

    The records name the picture files, which keeps the written set small, or
    carry the pixels. ``records`` and ``labelled`` each decode the pictures to
    see that they can be. The folder is listed once: the picture reader gives a row
    for every file, so its paths are the listing.
    """
    manifest = vision.normalize_manifest(
        read_manifest(spark, manifest_path, format, schema), options
    )
    images = read_images(spark, image_dir)
    return VisionResult(
        vision.vision_records(manifest, images=images, with_pixels=with_pixels),
        vision.label_manifest(manifest, images=images),
    )
