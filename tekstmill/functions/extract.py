"""Text out of HTML, mail bodies and JSON trees, and the records built from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .references import decode_references
from .settle import settle
from .text import bind

# Page parts that are never body text. They are removed whole, one pattern per element,
# because a shared pattern would need a back-reference for the closing tag.
DROPPED_ELEMENTS = ["script", "style", "noscript", "head", "nav", "header", "footer", "aside", "form"]
AD_BLOCK = r'(?is)<div[^>]*class="ad"[^>]*>.*?</div\s*>'
BODY_SLICE = r"(?is)<(?:article|main)\b[^>]*>(.*)</(?:article|main)\s*>"
BLOCK_TAG = r"(?i)</?(?:p|div|br|h[1-6]|li|ul|ol|tr|table|section|article|main|blockquote|pre)\b[^>]*>"
ANY_TAG = r"<[^>]*>"
COMMENT = r"(?s)<!--.*?-->"
BLANKS = r"[ \t\r\f]+"
BLANKS_AT_BREAK = r" ?\n[ \n]*"

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("added", T.StringType()),
        T.StructField("created", T.StringType()),
        T.StructField(
            "metadata",
            T.StructType(
                [
                    T.StructField("filename", T.StringType()),
                    T.StructField("filetype", T.StringType()),
                    T.StructField("filesize", T.LongType()),
                    T.StructField("page_count", T.IntegerType()),
                    T.StructField("file_path", T.StringType()),
                ]
            ),
        ),
    ]
)


def collapse_newlines(text: Column) -> Column:
    return F.regexp_replace(text, r"\n+", "\n")


def html_to_text(html: Column) -> Column:
    """Body text of a page: one line per block, NULL where nothing is left. Pass it through ``settle`` before anything
    names it more than once."""
    page = F.regexp_replace(html, COMMENT, "")
    for name in DROPPED_ELEMENTS:
        page = F.regexp_replace(page, rf"(?is)<{name}\b[^>]*>.*?</{name}\s*>", "")
    page = F.regexp_replace(page, AD_BLOCK, "")

    def body_of(whole: Column) -> Column:
        body = F.regexp_extract(whole, BODY_SLICE, 1)
        return F.when(body != "", body).otherwise(whole)

    page = bind(page, body_of)
    page = F.regexp_replace(page, BLOCK_TAG, "\n")
    page = F.regexp_replace(page, ANY_TAG, "")
    page = decode_references(page)
    page = F.regexp_replace(page, BLANKS, " ")
    page = F.regexp_replace(page, BLANKS_AT_BREAK, "\n")
    return F.nullif(F.btrim(page, F.lit("\n ")), F.lit(""))


def choose_format(content: Column, text_format: str) -> Column:
    """``txt`` keeps the text, ``html`` extracts it; any other name counts as ``txt``."""
    return html_to_text(content) if text_format == "html" else content


def unwrap_url(link: Column) -> Column:
    """Target of a safe-link URL, or NULL.

    Parameters are read from the left. Reading ends at ``url``, whose value is the
    target, or at the first parameter that is not of the form ``name=value``, which
    makes the link unreadable.
    """
    query = F.when(link.contains("?"), F.substring(link, F.locate("?", link) + 1, F.length(link)))
    params = F.split(F.when(query.contains("&"), query), "&")

    def is_pair(param: Column) -> Column:
        return F.length(param) - F.length(F.replace(param, F.lit("="))) == 1

    deciding = F.filter(params, lambda p: ~is_pair(p) | p.startswith("url="))
    return bind(
        F.get(deciding, F.lit(0)),
        lambda p: F.when(is_pair(p), percent_decode(F.substring(p, F.lit(5), F.length(p)))),
    )


def percent_decode(value: Column) -> Column:
    """Decode ``%xx`` only: a plus sign and a broken escape stay as they are."""
    kept = F.regexp_replace(F.regexp_replace(value, r"\+", "%2B"), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(kept), value)


def clean_mail_body(body: Column) -> Column:
    """Collapse newline runs, drop ``[...]`` and carriage returns, unwrap links.

    A link runs up to the next ``>``, so cutting the text at ``>`` leaves at most one
    link per piece, and it reaches to the end of its piece.
    """
    text = collapse_newlines(body)
    text = F.regexp_replace(text, r"\[[^\n]+?\]", "")
    text = F.replace(text, F.lit("\r"))
    link_piece = r"(?s)^(.*?)(https?://.+)$"

    def rewrite(piece: Column) -> Column:
        link = F.regexp_extract(piece, link_piece, 2)
        before = F.regexp_extract(piece, link_piece, 1)
        return F.when(link == "", piece).otherwise(F.concat(before, F.coalesce(F.nullif(unwrap_url(link), F.lit("")), link)))

    return F.array_join(F.transform(F.split(text, ">"), rewrite), ">")


def path_texts(value: Column, data_type: T.DataType, keys: list[str]) -> Column:
    """Texts found by walking ``keys`` through a value of a known type, as an array.

    A list passes the same remaining keys on to its elements; at the end of the path a
    list is flattened, an object becomes JSON text and a scalar its string form. A key
    that the type lacks gives no text.
    """
    nothing = F.array().cast("array<string>")
    if isinstance(data_type, T.ArrayType):
        found = F.flatten(F.transform(value, lambda v: path_texts(v, data_type.elementType, keys)))
    elif keys:
        key, rest = keys[0], keys[1:]
        if isinstance(data_type, T.StructType) and key in data_type.fieldNames():
            found = path_texts(value.getField(key), data_type[key].dataType, rest)
        elif isinstance(data_type, T.MapType):
            found = path_texts(F.try_element_at(value, F.lit(key)), data_type.valueType, rest)
        else:
            found = nothing
    elif isinstance(data_type, (T.StructType, T.MapType)):
        found = F.array(F.to_json(value))
    else:
        found = F.array(value.cast("string"))
    return F.coalesce(F.filter(found, lambda t: t.isNotNull()), nothing)


def json_path_texts(json_text: Column, schema: T.DataType, path: str) -> Column:
    """As :func:`path_texts` for JSON held in a string column; broken JSON gives no text."""
    return path_texts(F.from_json(json_text, schema), schema, path.split(","))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_suffix(path: Column) -> Column:
    """Last suffix with its dot, empty where the name has none."""
    name = F.ltrim(file_name(path), F.lit("."))
    return F.regexp_extract(name, r"(\.[^.]+)$", 1)


def file_metadata(path: Column, size: Column, stream: bool = False, page_count: Column | None = None) -> Column:
    """File facts as a struct. ``filetype`` holds all suffixes of a path (``.tar.gz``),
    for a stream the last one without its dot."""
    name = file_name(path)
    if stream:
        filetype = F.element_at(F.split(name, r"\."), -1)
    else:
        filetype = F.regexp_extract(F.ltrim(name, F.lit(".")), r"^[^.]*((?:\.[^.]+)*)$", 1)
    pages = F.lit(0) if page_count is None else page_count.cast("int")
    return F.struct(
        name.alias("filename"),
        filetype.alias("filetype"),
        size.cast("bigint").alias("filesize"),
        pages.alias("page_count"),
        path.alias("file_path"),
    )


def record_id(source: Column, filename: Column) -> Column:
    return F.replace(F.concat(source, F.lit("-"), F.coalesce(filename, F.lit(""))), F.lit(" "), F.lit("-"))


def document_record(text: Column, source: Column, metadata: Column, now: str) -> list[Column]:
    """The columns of an extracted record. ``now`` is the text form of the run's time."""
    return [
        record_id(source, metadata.getField("filename")).alias("id"),
        text.alias("text"),
        source.alias("source"),
        F.lit(now).alias("added"),
        F.lit(f"2000-01-01 00:00:00, {now}").alias("created"),
        metadata.alias("metadata"),
    ]


# Words and links of a block, for the main-text scan.
WORD = r"[\p{L}\p{N}]+"
LINK_TEXT = r"(?is)<a\b[^>]*>(.*?)</a\s*>"


def _visible(html: Column) -> Column:
    """The page without comments, never-text elements and adverts."""
    page = F.regexp_replace(html, COMMENT, "")
    for name in DROPPED_ELEMENTS:
        page = F.regexp_replace(page, rf"(?is)<{name}\b[^>]*>.*?</{name}\s*>", "")
    return F.regexp_replace(page, AD_BLOCK, "")


def block_score(block: Column) -> Column:
    """Words, less twice the words inside links, less the tags, less one for the block's own boundary."""
    words = F.size(F.regexp_extract_all(F.regexp_replace(block, ANY_TAG, ""), F.lit(WORD), F.lit(0)))
    linked = F.array_join(F.regexp_extract_all(block, F.lit(LINK_TEXT), F.lit(1)), " ")
    link_words = F.size(F.regexp_extract_all(F.regexp_replace(linked, ANY_TAG, ""), F.lit(WORD), F.lit(0)))
    tags = F.size(F.regexp_extract_all(block, F.lit(ANY_TAG), F.lit(0)))
    return words - 2 * link_words - tags - 1


def best_run(scores: Column) -> Column:
    """(total, first, last) of the run of greatest sum (1-based, inclusive); of equal sums the one that ends first,
    and of those the one that starts first. One pass: the least prefix sum so far and where it was reached."""
    start = F.struct(
        F.lit(0).alias("i"), F.lit(0).alias("prefix"), F.lit(0).alias("low"), F.lit(0).alias("low_at"),
        F.lit(None).cast("int").alias("best"), F.lit(0).alias("first"), F.lit(0).alias("last"),
    )

    def step(state: Column, score: Column) -> Column:
        i, prefix = state["i"] + 1, state["prefix"] + score
        gain = prefix - state["low"]
        better = state["best"].isNull() | (gain > state["best"])
        lower = prefix < state["low"]
        return F.struct(
            i.alias("i"), prefix.alias("prefix"),
            F.when(lower, prefix).otherwise(state["low"]).alias("low"), F.when(lower, i).otherwise(state["low_at"]).alias("low_at"),
            F.when(better, gain).otherwise(state["best"]).alias("best"),
            F.when(better, state["low_at"] + 1).otherwise(state["first"]).alias("first"),
            F.when(better, i).otherwise(state["last"]).alias("last"),
        )

    return F.aggregate(scores, start, step)


def main_text_lines(html: Column) -> Column:
    """Native part of ``main_text``: the blocks of the run of greatest sum, without tags, one line each; NULL where no
    run has a positive sum. References are not decoded yet."""
    blocks = F.split(_visible(html), BLOCK_TAG, -1)

    def pick(parts: Column) -> Column:
        run = bind(best_run(F.transform(parts, block_score)), lambda r: r)
        return bind(run, lambda r: F.when(r["best"] > 0, F.slice(parts, F.greatest(r["first"], F.lit(1)), F.greatest(r["last"] - r["first"] + 1, F.lit(1)))))

    return F.array_join(F.transform(bind(blocks, pick), lambda b: F.regexp_replace(b, ANY_TAG, "")), "\n")


def finish_lines(lines: Column) -> Column:
    """References decoded, blanks evened out as in ``html_to_text``, NULL where nothing is left."""
    page = decode_references(lines)
    page = F.regexp_replace(page, BLANKS, " ")
    page = F.regexp_replace(page, BLANKS_AT_BREAK, "\n")
    return F.nullif(F.btrim(page, F.lit("\n ")), F.lit(""))


def main_text(df: DataFrame, html: str = "html", name: str = "text") -> DataFrame:
    """``df`` with the main text of each page by block segmentation, without landmarks: blocks between block tags are
    scored by ``block_score`` and the run of greatest sum is kept, one line per block with text; references are
    decoded and blanks evened out as in ``html_to_text``. NULL where no run has a positive sum or nothing is left.

    The native part and the decoding are two projections: an Arrow function can't take an input built by lambdas in
    the same one."""
    lines = settle(df, "__lines", main_text_lines(F.col(html)))
    return settle(lines, name, finish_lines(F.col("__lines"))).drop("__lines")
