"""One query per operator over the supplied tables.

Inputs that no table holds (mail bodies, safe links, broken encodings, crawl logs) are
derived by Spark from whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tekstmill.functions import extract, language
from tekstmill.functions.minhash import MinHashPlan
from tekstmill.functions.settle import settle
from tekstmill.functions.repair import repair_text
from tekstmill.functions.text import stop_words
from tekstmill.operators import chain, crawl, extraction, filters, minhash_dedup, sentence_dedup, sentences, tables
from tekstmill.plans import jobs
from tekstmill.plans.lineage import cut_lineage, scratch_path
from tekstmill.sources import readers, schema, writers

Query = Callable[[SparkSession, str], DataFrame]

# The languages of the supplied documents; there are no Danish ones among them.
LANGUAGES = ["en", "de", "fr", "es"]
# MD5 is what the other engine can compute as well.
MD5_PLAN = MinHashPlan(shingle_hash="md5")
OPH_PLAN = MinHashPlan(shingle_hash="md5", scheme="one_permutation")
FAST_PLAN = MinHashPlan()
NOW = "2024-05-01 12:00:00"

# Letters of the documents and what they become when UTF-8 is misread.
BROKEN_LETTERS = [
    ("é", "Ã©"),
    ("è", "Ã¨"),
    ("ê", "Ãª"),
    ("ç", "Ã§"),
    ("ü", "Ã¼"),
    ("ö", "Ã¶"),
    ("ä", "Ã¤"),
    ("ß", "ÃŸ"),
    ("ñ", "Ã±"),
    ("ó", "Ã³"),
    ("ú", "Ãº"),
]


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents", *(columns or ("doc_id", "text")))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


# -- extraction ---------------------------------------------------------------------


def collapse_newlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    spaced = F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n\n"))
    return documents(spark, sf_dir).select("doc_id", extract.collapse_newlines(spaced).alias("text"))


def html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies, with character references of all kinds added to each article."""
    more = "<p>It&rsquo;s &#8217;&euro;&iacute;&#x2014; &#38;amp;</p></article>"
    html = F.replace(F.col("html"), F.lit("</article>"), F.lit(more))
    text = settle(pages(spark, sf_dir).select("page_id", "html"), "text", extract.html_to_text(html))
    return text.select("page_id", "text").filter(F.col("text").isNotNull())


def main_text_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by block segmentation, with its landmarks (article, main, nav) renamed to div, so
    that menus go by their link density alone."""
    html = F.regexp_replace("html", r"(?i)<(/?)(article|main|nav)\b", "<$1div")
    return extract.main_text(pages(spark, sf_dir).select("page_id", html.alias("html"))).select("page_id", "text")


def json_path_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    shape = T.StructType([T.StructField("k", T.LongType())])
    texts = extract.json_path_texts(F.col("props"), shape, "k")
    return table(spark, sf_dir, "events", "event_id", "props").select("event_id", F.explode(texts).alias("text"))


def json_path_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A path through a list: two records per conversation turn."""
    turns = table(spark, sf_dir, "conversations")
    body = F.struct(
        F.array(F.struct(F.col("text").alias("t")), F.struct(F.upper("role").alias("t"))).alias("parts")
    )
    turns = turns.select("conv_id", "turn", body.alias("doc"))
    shape = turns.schema["doc"].dataType
    texts = extract.json_path_texts(F.to_json("doc"), shape, "parts,t")
    return turns.select("conv_id", "turn", F.explode(texts).alias("text"))


def json_mixed_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation turn as a JSON document of one of six shapes (string, list, list at the top, missing key,
    nested lists with scalars, broken), walked by each value's own kind."""
    from tekstmill.operators.json_walk import walk_json

    turns = table(spark, sf_dir, "conversations")
    shape = (F.col("conv_id") + F.col("turn")) % 6
    nested = F.concat(
        F.lit('{"text": ['), F.to_json(F.array("text")), F.lit(", ["), F.to_json(F.array("role")),
        F.lit("], "), F.col("turn").cast("string"), F.lit(", true, null]}"),
    )
    json = (
        F.when(shape == 0, F.to_json(F.struct("text", "role")))
        .when(shape == 1, F.to_json(F.struct(F.array("text", F.upper("role")).alias("text"))))
        .when(shape == 2, F.concat(
            F.lit("["), F.to_json(F.struct("text")), F.lit(","), F.to_json(F.struct(F.col("role").alias("text"))),
            F.lit(","), F.col("turn").cast("string"), F.lit("]"),
        ))
        .when(shape == 3, F.to_json(F.struct(F.struct("role").alias("meta"))))
        .when(shape == 4, nested)
        .otherwise(F.concat(F.lit('{"text": '), F.to_json(F.array("text"))))
    )
    walked = walk_json(turns.select("conv_id", "turn", json.alias("json")), F.col("json"), ["text"], ["conv_id", "turn"])
    return walked.select("conv_id", "turn", "outcome", "detail", F.array_join("position", ",").alias("position"), "text")


def extraction_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a file of the suffix ``route_by_suffix`` gives it, some broken on purpose (bad UTF-8, pages
    without text, broken JSON, JSON without the key), extracted with an outcome for everything: per file and outcome
    the number of rows."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source", "n_chars")
    path = _routed_path()
    text = F.coalesce(F.col("text"), F.lit(""))
    shape = F.col("doc_id") % 5
    json = (
        F.when(shape == 0, F.to_json(F.struct("text")))
        .when(shape == 1, F.to_json(F.array(F.struct("text"), F.struct(F.col("source").alias("text")))))
        .when(shape == 2, F.to_json(F.struct(F.col("text").alias("other"))))
        .when(shape == 3, F.concat(F.lit('{"text": '), F.to_json(F.array("text"))))
        .otherwise(F.concat(F.lit('{"text": ['), F.to_json(F.array("text")), F.lit(", "), F.to_json(F.array("lang")), F.lit("]}")))
    )
    page = F.when(F.col("doc_id") % 3 == 0, F.lit("<html><body><script>var x = 1;</script></body></html>")).otherwise(
        F.concat(F.lit("<html><body><p>"), text, F.lit("</p></body></html>"))
    )
    suffix = F.regexp_extract(path, r"\.([^.]+)$", 1)
    body = F.when(suffix == "json", json).when(suffix == "html", page).otherwise(text).cast("binary")
    body = F.when(suffix.isin("txt", "md") & (F.col("doc_id") % 11 == 0), F.concat(body, F.unhex(F.lit("FF")))).otherwise(body)
    files = docs.select(path.alias("path"), body.alias("content"))
    outcomes = extraction.extract_file_rows(files)
    doc_id = F.regexp_extract("path", r"/(\d+)\.v2\.", 1).cast("bigint")
    return outcomes.groupBy(doc_id.alias("doc_id"), "rule", "outcome", "detail").agg(F.count("*").alias("records"))


# A sentence with a decimal number and abbreviations, added to every document.
ABBREVIATED = " Prisen er 3.5 kr. kl. 12 i dag, bl.a. det nye."


def _abbreviated(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    return docs.select("doc_id", F.concat(F.coalesce("text", F.lit("")), F.lit(ABBREVIATED)).alias("text"))


def abbreviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Abbreviations learned from all documents by collocation log-likelihood and orthographic evidence."""
    found = sentences.learn_abbreviations(_abbreviated(spark, sf_dir))
    return found.select("type", "with_period", "tokens", "lower_next", F.round("score", 6).alias("score"))


def learned_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut into sentences with the abbreviations learned from them all."""
    docs = _abbreviated(spark, sf_dir)
    cut = sentences.learned_sentences(docs, sentences.learn_abbreviations(docs))
    return cut.select("doc_id", F.posexplode("sentences").alias("pos", "sentence")).withColumn("pos", F.col("pos").cast("bigint"))


def _mail_body() -> Column:
    link = F.concat(
        F.lit("https://safe.example.com/?d=x&url=http%3A%2F%2Fdocs.example.org%2F"), F.col("doc_id"), F.lit("&z=1")
    )
    return F.concat(
        F.lit("[cid:image"), F.col("doc_id"), F.lit("]\r\n\n\n<"), link, F.lit("> "), F.col("text"),
        F.lit("\n\n[external] <http://plain.example.net/"), F.col("doc_id"), F.lit(">\r\n"),
    )


def clean_mail_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", extract.clean_mail_body(_mail_body()).alias("text"))


def unwrap_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = F.replace(F.replace(F.col("url"), F.lit(":"), F.lit("%3A")), F.lit("/"), F.lit("%2F"))
    encoded = F.replace(F.replace(encoded, F.lit("?"), F.lit("%3F")), F.lit("="), F.lit("%3D"))
    encoded = F.replace(encoded, F.lit("&"), F.lit("%26"))
    forms = F.array(
        F.concat(F.lit("https://safe.example.com/?a=b&url="), encoded, F.lit("&c=d")),
        F.concat(F.lit("https://safe.example.com/?url="), encoded),
        F.concat(F.lit("https://safe.example.com/?odd&url="), encoded),
        F.concat(F.lit("https://safe.example.com/?url="), encoded, F.lit("&odd")),
        F.col("url"),
    )
    links = table(spark, sf_dir, "pages", "page_id", "url").select("page_id", F.posexplode(forms).alias("form", "link"))
    return links.select("page_id", "form", extract.unwrap_url(F.col("link")).alias("target"))


def _page_path() -> Column:
    name = F.regexp_replace("url", r"[^A-Za-z0-9.]+", "_")
    return F.concat(F.lit("/crawl/"), F.col("page_id"), F.lit("/"), name, F.lit(".page v1.html"))


def file_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = extract.file_metadata(_page_path(), F.octet_length("html"))
    return pages(spark, sf_dir).select("page_id", meta.alias("m")).select("page_id", "m.*")


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = extract.file_metadata(_page_path(), F.octet_length("html"))
    record = extract.document_record(F.col("html"), F.lit("web crawl"), meta, NOW)
    return pages(spark, sf_dir).select(*record).select(
        "id", "text", "source", "added", "created", "metadata.filename", "metadata.filetype", "metadata.filesize",
        "metadata.page_count", "metadata.file_path",
    )


def _routed_path() -> Column:
    kinds = ["txt", "md", "html", "json", "HTML", "pdf"]
    suffix = F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.length("source") + F.col("n_chars")).cast("int") % 6 + 1)
    return F.concat_ws("/", F.lit("/in"), F.col("source"), F.concat(F.col("doc_id"), F.lit(".v2."), suffix))


def route_by_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = table(spark, sf_dir, "documents", "doc_id", "source", "n_chars").select("doc_id", _routed_path().alias("path"))
    return paths.select("doc_id", "path", extraction.route(F.col("path")).alias("route"))


# -- crawl --------------------------------------------------------------------------


def _crawl_log(spark: SparkSession, sf_dir: str, rows: Column) -> DataFrame:
    """A crawl log written from the pages and read back as a file."""
    path = scratch_path(spark, "crawl-log")
    line = F.concat(F.lit("--2024-05-01 12:00:00--  "), F.col("url"))
    noise = F.concat(F.lit("Resolving "), F.col("url"))
    lines = table(spark, sf_dir, "pages", "url", "html").filter(rows).select(F.explode(F.array(line, noise)).alias("value"))
    lines.write.text(path)
    return readers.read_crawl_log(spark, path)


def crawl_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crawl.crawl_hosts(_crawl_log(spark, sf_dir, F.lit(True)))


def crawl_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages on hosts that the log of the English pages names."""
    hosts = crawl.crawl_hosts(_crawl_log(spark, sf_dir, F.col("html").contains('<html lang="en">')))
    rows = table(spark, sf_dir, "pages", "page_id", "url").withColumn(
        "path", F.concat(F.lit("/data/"), F.regexp_replace("url", "^https?://", ""))
    )
    return crawl.select_hosts(rows, hosts, crawl.top_folder(F.col("path"), "/data")).select("page_id", "host")


# -- tables -------------------------------------------------------------------------


def _wide_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    partly = F.when(F.col("l_linenumber") <= 3, F.lit(-1.0)).otherwise(F.col("l_quantity"))
    note = F.concat(F.col("l_returnflag"), F.lit("\n"), F.col("l_linestatus"))
    return items.withColumns({"copy": F.col("l_extendedprice"), "partly": partly, "note": note})


def near_dup_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.near_duplicate_columns(_wide_lineitem(spark, sf_dir), 0.3)


def column_pair_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.column_pair_shares(table(spark, sf_dir, "lineitem"))


def clean_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = _wide_lineitem(spark, sf_dir)
    names = ["note" if c == "l_returnflag" else c for c in wide.columns]
    return tables.clean_table(wide.toDF(*names), 0.8)


def strip_newlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.strip_newlines(documents(spark, sf_dir, "doc_id", "text", "lang"))


# -- filters ------------------------------------------------------------------------


def repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts whose accented letters have been misread, with entities, curly quotes, a
    control character and a decomposed letter added."""
    text = F.col("text")
    for good, bad in BROKEN_LETTERS:
        text = F.replace(text, F.lit(good), F.lit(bad))
    broken = F.concat(F.lit("“Caf"), F.lit("é”\u0007 &amp; &lt;b&gt;\n"), text)
    return repair_text(documents(spark, sf_dir).select("doc_id", broken.alias("text")))


def _profiles(spark: SparkSession, sf_dir: str) -> dict[str, list[str]]:
    return language.load_profiles(language.learn_profiles(documents(spark, sf_dir, "doc_id", "text", "lang")), LANGUAGES)


def language_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.learn_profiles(documents(spark, sf_dir, "doc_id", "text", "lang")).withColumn(
        "rank", F.col("rank").cast("bigint")
    )


def language_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = filters.language_filter(documents(spark, sf_dir), ["en"], _profiles(spark, sf_dir))
    return docs.drop("text")


def language_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels beside the true languages, with nothing rejected."""
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    labelled = filters.language_filter(docs, ["en"], _profiles(spark, sf_dir), label_only=True)
    return labelled.groupBy("lang", "language").agg(
        F.count(F.lit(1)).alias("documents"), F.count("reason").alias("rejected")
    )


def language_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out accuracy of the n-gram language model per language: learned from even ids, tested on odd ones."""
    from tekstmill.functions import language_model

    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    model = language_model.LanguageModel(language_model.learn_counts(docs.filter(F.col("doc_id") % 2 == 0)))
    scored = language_model.score_languages(docs.filter(F.col("doc_id") % 2 == 1), model)
    return scored.groupBy("lang").agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(F.col("language") == F.col("lang")).alias("correct")
    )


def repetition_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = filters.line_repetition(F.col("text"))
    return documents(spark, sf_dir).select("doc_id", *[v.alias(k) for k, v in shares.items()])


def repetition_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.ngram_repetition(documents(spark, sf_dir)).drop("text")


def repetition_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.repetition_filter(documents(spark, sf_dir)).drop("text")


def quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.quality_filter(documents(spark, sf_dir), stop_words("en")).drop("text")


def line_clean_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.line_clean_filter(documents(spark, sf_dir))


def line_structure_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.line_structure_filter(documents(spark, sf_dir)).drop("text")


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = filters.token_count(documents(spark, sf_dir)).drop("text")
    return counted.withColumn("token_count", F.col("token_count").cast("bigint"))


def _chain(spark: SparkSession, sf_dir: str, docs: DataFrame, languages: list[str]) -> DataFrame:
    steps = chain.default_steps(languages, _profiles(spark, sf_dir), stop_words("en"))
    return chain.apply_chain(docs, steps)


def filter_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _chain(spark, sf_dir, documents(spark, sf_dir), ["en"])
    return docs.select("doc_id", "text", "rejected_by", "reason", F.col("token_count").cast("bigint").alias("token_count"))


def filter_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "source").withColumnRenamed("source", "dataset")
    return chain.outcome_stats(_chain(spark, sf_dir, docs, LANGUAGES))


def exclusion_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejections written with one folder per filter, read back from there."""
    path = scratch_path(spark, "excluded")
    docs = _chain(spark, sf_dir, documents(spark, sf_dir), ["en"]).filter(F.col("rejected_by").isNotNull())
    writers.write_documents(docs, path, "zstd", partition_by=("rejected_by",))
    return spark.read.parquet(path).select("doc_id", "rejected_by", "reason")


# -- sentence deduplication ----------------------------------------------------------


def sentence_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = sentence_dedup.sentence_windows(documents(spark, sf_dir), hex_form=True)
    return windows.withColumn("pos", F.col("pos").cast("bigint"))


def sentence_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = sentence_dedup.sentence_windows(documents(spark, sf_dir), hex_form=True)
    found = sentence_dedup.duplicate_windows(windows)
    return found.withColumn("pos", F.col("pos").cast("bigint"))


def sentence_duplicates_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as ``sentence_duplicates``, in two batches split at the median id: the second is deduplicated against
    a lasting, bucketed index of the first."""
    from tekstmill.operators.window_index import WindowIndex

    docs = documents(spark, sf_dir)
    middle = docs.agg(F.percentile_approx("doc_id", 0.5)).first()[0]
    first = docs.filter(F.col("doc_id") <= middle) if middle is not None else docs
    second = docs.filter(F.col("doc_id") > middle) if middle is not None else docs.limit(0)
    index = WindowIndex(spark)
    windows = sentence_dedup.sentence_windows(first, hex_form=True)
    found = cut_lineage(index.duplicates(windows), "batch-one")
    index.add(windows)
    more = index.duplicates(sentence_dedup.sentence_windows(second, hex_form=True))
    return found.unionByName(more).withColumn("pos", F.col("pos").cast("bigint"))


def sentence_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = sentence_dedup.deduplicate_sentences(documents(spark, sf_dir))
    return docs.withColumn("removed_sentences", F.col("removed_sentences").cast("bigint"))


# -- document deduplication ----------------------------------------------------------


def minhash_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    signed = minhash_dedup.minhash_signatures(documents(spark, sf_dir), plan=MD5_PLAN)
    rows = signed.select("doc_id", F.posexplode("signature").alias("k", "value"))
    return rows.withColumn("k", F.col("k").cast("bigint"))


def _edges(spark: SparkSession, sf_dir: str, plan: MinHashPlan) -> DataFrame:
    signed = minhash_dedup.minhash_signatures(documents(spark, sf_dir), plan=plan)
    return minhash_dedup.match_buckets(signed, plan=plan)


def minhash_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edges(spark, sf_dir, MD5_PLAN)


def duplicate_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.duplicate_clusters(_edges(spark, sf_dir, MD5_PLAN))


def cluster_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.cluster_sizes(minhash_dedup.duplicate_clusters(_edges(spark, sf_dir, MD5_PLAN)))


def minhash_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, removed = minhash_dedup.deduplicate_documents(documents(spark, sf_dir), plan=MD5_PLAN)
    kept = kept.select("doc_id", F.lit(True).alias("kept"), F.col("doc_id").alias("survivor"))
    return kept.union(removed.select("doc_id", F.lit(False), "cluster"))


def minhash_dedup_fast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the default hash, which only Spark computes."""
    kept, _ = minhash_dedup.deduplicate_documents(documents(spark, sf_dir), plan=FAST_PLAN)
    return kept


def oph_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signatures of one permutation dealt into bins, densified by rotation."""
    signed = minhash_dedup.minhash_signatures(documents(spark, sf_dir), plan=OPH_PLAN)
    rows = signed.select("doc_id", F.posexplode("signature").alias("k", "value"))
    return rows.withColumn("k", F.col("k").cast("bigint"))


def minhash_dedup_oph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document deduplication on one-permutation signatures."""
    kept, removed = minhash_dedup.deduplicate_documents(documents(spark, sf_dir), plan=OPH_PLAN)
    return kept.select("doc_id", F.lit(True).alias("kept"), F.col("doc_id").alias("survivor")).unionByName(
        removed.select("doc_id", F.lit(False).alias("kept"), F.col("cluster").alias("survivor"))
    )


# -- whole jobs ----------------------------------------------------------------------


def _job_input(spark: SparkSession, sf_dir: str) -> str:
    """The documents in the order of their ids, with metadata that holds a number and a nested value."""
    path = scratch_path(spark, "job-input")
    meta = F.struct(F.col("n_chars").alias("n"), F.struct("lang", F.array("source").alias("s")).alias("o"))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "text", F.to_json(meta).alias("metadata"), "doc_id")
    docs.orderBy("doc_id").drop("doc_id").write.parquet(path)
    return path


def _job_output(spark: SparkSession, folder: str, kept: bool) -> DataFrame:
    return spark.read.parquet(folder).select(F.col("id").cast("bigint").alias("doc_id"), "text", "metadata", F.lit(kept).alias("kept"))


def job_sentence_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the sentence job writes, survivors and removed documents, read back."""
    out = scratch_path(spark, "job-sentences")
    jobs.run_sentence_dedup(spark, _job_input(spark, sf_dir), f"{out}/kept", f"{out}/gone")
    return _job_output(spark, f"{out}/kept/sent_dedup_output", True).union(_job_output(spark, f"{out}/gone/sent_dedup", False))


def job_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "job-minhash")
    jobs.run_minhash_dedup(spark, _job_input(spark, sf_dir), f"{out}/kept", f"{out}/gone", plan=MD5_PLAN)
    return _job_output(spark, f"{out}/kept/deduplicated_output", True).union(_job_output(spark, f"{out}/gone/removed", False))


def job_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filter job from JSON lines to its two outputs."""
    out = scratch_path(spark, "job-filter")
    lines = writers.write_jsonl(documents(spark, sf_dir, "doc_id", "text"), out, "docs")
    steps = chain.default_steps(["en"], _profiles(spark, sf_dir), stop_words("en"))
    data = jobs.Dataset("docs", lines, f"{out}/kept", f"{out}/gone", "*.gz")
    jobs.run_filter(spark, [data], steps, "doc_id bigint, text string")
    kept = spark.read.parquet(f"{out}/kept/filter_output").select("doc_id", "text", F.lit(None).cast("string").alias("rejected_by"))
    return kept.union(spark.read.parquet(f"{out}/gone").select("doc_id", "text", "rejected_by"))


def choose_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pages as plain text and as HTML."""
    rows = pages(spark, sf_dir).select("page_id", F.col("html").alias("as_text"))
    rows = settle(rows, "as_html", extract.choose_format(F.col("as_text"), "html"))
    return rows.select("page_id", F.md5(extract.choose_format(F.col("as_text"), "txt").cast("binary")).alias("as_text"), "as_html")


# -- sources and sinks ---------------------------------------------------------------


def metadata_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata written as JSON text, read back as a map with a default added."""
    path = scratch_path(spark, "parquet-documents")
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        "text",
        F.struct(F.col("lang"), F.col("source"), F.col("n_chars")).alias("metadata"),
    )
    writers.write_documents(docs, path, "gzip")
    back = readers.read_documents(spark, path, default_metadata={"origin": "supplied", "lang": "unknown"})
    entry = lambda k: F.try_element_at("metadata", F.lit(k)).alias(k)
    return back.select("id", "text", entry("lang"), entry("source"), entry("n_chars"), entry("origin"))


def read_skip_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reader's own skip and limit, without metadata and under other key names."""
    return readers.read_documents(
        spark, sf_dir, glob_pattern="documents.parquet", read_metadata=False, text_key="lang", id_key="doc_id",
        skip=5, limit=50, order_by=["doc_id"],
    )


def nullable_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Void columns and elements become strings on the way through a parquet file."""
    path = scratch_path(spark, "nullable")
    events = table(spark, sf_dir, "events").select(
        "event_id", F.lit(None).alias("nothing"), F.array().alias("none"), F.struct("event_type", F.lit(None).alias("v")).alias("s")
    )
    schema.normalise_schema(events).write.parquet(path)
    back = spark.read.parquet(path)
    kinds = {f.name: f.dataType.simpleString() for f in back.schema.fields}
    return back.select(
        "event_id", "nothing", "s.event_type", F.array_size("none").cast("bigint").alias("none_size"),
        *[F.lit(kinds[c]).alias(f"{c}_type") for c in ("nothing", "none", "s")],
    )


def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = writers.write_jsonl(documents(spark, sf_dir, "doc_id", "text", "lang"), scratch_path(spark, "jsonl"), "docs")
    return readers.read_jsonl(spark, path, "*.gz", "doc_id bigint, text string, lang string")


def dataset_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.union_datasets(
        {
            "documents": table(spark, sf_dir, "documents", "text", "lang"),
            "benchmark": table(spark, sf_dir, "benchmark", "text"),
            "turns": table(spark, sf_dir, "conversations", "text", "role"),
        }
    )


QUERIES: dict[str, Query] = {
    "collapse_newlines": collapse_newlines,
    "html_to_text": html_to_text,
    "main_text_blocks": main_text_blocks,
    "json_path_text": json_path_text,
    "json_path_list": json_path_list,
    "json_mixed_shapes": json_mixed_shapes,
    "extraction_outcomes": extraction_outcomes,
    "abbreviations": abbreviations,
    "learned_sentences": learned_sentences,
    "clean_mail_body": clean_mail_body,
    "unwrap_urls": unwrap_urls,
    "file_metadata": file_metadata,
    "document_records": document_records,
    "route_by_suffix": route_by_suffix,
    "crawl_hosts": crawl_hosts,
    "crawl_select": crawl_select,
    "near_dup_columns": near_dup_columns,
    "column_pair_shares": column_pair_shares,
    "clean_table": clean_table,
    "strip_newlines": strip_newlines,
    "repair_text": repair,
    "language_profiles": language_profiles,
    "language_filter": language_filter,
    "language_label": language_label,
    "language_accuracy": language_accuracy,
    "repetition_lines": repetition_lines,
    "repetition_ngrams": repetition_ngrams,
    "repetition_filter": repetition_filter,
    "quality_filter": quality_filter,
    "line_clean_filter": line_clean_filter,
    "line_structure_filter": line_structure_filter,
    "token_counts": token_counts,
    "filter_chain": filter_chain,
    "filter_stats": filter_stats,
    "exclusion_sink": exclusion_sink,
    "sentence_windows": sentence_windows,
    "sentence_duplicates": sentence_duplicates,
    "sentence_duplicates_batches": sentence_duplicates_batches,
    "sentence_dedup": sentence_dedup_query,
    "minhash_signatures": minhash_signatures,
    "minhash_edges": minhash_edges,
    "duplicate_clusters": duplicate_clusters,
    "cluster_report": cluster_report,
    "minhash_dedup": minhash_dedup_query,
    "minhash_dedup_fast": minhash_dedup_fast,
    "oph_signatures": oph_signatures,
    "minhash_dedup_oph": minhash_dedup_oph,
    "job_filter": job_filter,
    "job_sentence_dedup": job_sentence_dedup,
    "job_minhash_dedup": job_minhash_dedup,
    "choose_format": choose_format,
    "metadata_roundtrip": metadata_roundtrip,
    "read_skip_limit": read_skip_limit,
    "nullable_schema": nullable_schema,
    "jsonl_roundtrip": jsonl_roundtrip,
    "dataset_union": dataset_union,
}
