"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from monthtide.llm.chat_format import chat_windows, read_back
from monthtide.llm.decontamination import contaminated
from monthtide.llm.exact_dedup import content_sort
from monthtide.llm.fast_sketch import sketch_components
from monthtide.llm.frames import table
from monthtide.llm.jaccard_join import jaccard_components
from monthtide.llm.language_id import predicted_languages
from monthtide.llm.license_scan import scan_licenses
from monthtide.llm.merkle_manifest import manifest_audit
from monthtide.llm.mixing import mixed_documents
from monthtide.llm.spelling_variants import SLIP, spelling_variants
from monthtide.llm.token_counts import length_histogram
from monthtide.llm.url_filter import judged_urls
from monthtide.llm.warc import derivatives, responses

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), any_case=True
    )
    return found.drop("bindings")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judged_urls(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_documents(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram(table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op7_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derivatives(responses(table(spark, sf_dir, "pages")))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicted_languages(table(spark, sf_dir, "documents"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations")
    kinds = {f.name: f.dataType.simpleString() for f in turns.schema}
    names = ["conv_id", "turn", "role", "text"]
    own = spark.range(2).selectExpr(
        f"cast(-1 as {kinds['conv_id']}) as conv_id",
        f"cast(id as {kinds['turn']}) as turn",
        "if(id = 0, 'user', 'assistant') as role",
        f"'{said}' as text",
    )
    return read_back(chat_windows(turns.select(names).union(own.select(names))))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort(table(spark, sf_dir, "documents"), keep="largest")


def op11_fast_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch_components(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_audit(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), slip=SLIP)


def registered() -> dict[str, Query]:
    return {
        "op1_decontaminate": op1_decontaminate,
        "op2_jaccard_join": op2_jaccard_join,
        "op3_url_filter": op3_url_filter,
        "op4_mix_sources": op4_mix_sources,
        "op5_token_counts": op5_token_counts,
        "op6_license_scan": op6_license_scan,
        "op7_warc_derivatives": op7_warc_derivatives,
        "op8_language_id": op8_language_id,
        "op9_chat_format": op9_chat_format,
        "op10_exact_dedup": op10_exact_dedup,
        "op11_fast_sketch": op11_fast_sketch,
        "op12_merkle_manifest": op12_merkle_manifest,
        "op13_spelling_variants": op13_spelling_variants,
    }
