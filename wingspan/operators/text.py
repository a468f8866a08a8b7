"""Documents: HTML to text, section chunks, chunk fields (TX1-TX6, SF14-SF20).

Everything is built-in string and regex expressions evaluated per row in
the JVM (whole-stage codegen), never a Python loop over collected rows.
Patterns avoid look-around so the same text runs on RE2 engines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# HTML entity replacements applied after tag removal.
HTML_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "),
                 ("&amp;", "&"))
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def collapse_ws(c: Column) -> Column:
    """SF15: collapse whitespace runs and trim."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def html_to_text(html: Column) -> Column:
    """TX1: drop script/style blocks, comments and tags; decode entities; tidy spaces."""
    t = F.regexp_replace(html, r"(?is)<script[^>]*>.*?</script>", " ")
    t = F.regexp_replace(t, r"(?is)<style[^>]*>.*?</style>", " ")
    t = F.regexp_replace(t, r"(?s)<!--.*?-->", " ")
    t = F.regexp_replace(t, r"<[^>]*>", " ")
    for ent, ch in HTML_ENTITIES:
        t = F.replace(t, F.lit(ent), F.lit(ch))
    return collapse_ws(t)


def page_text(pages: DataFrame) -> DataFrame:
    """TX1: one row per page with title, text, size and a parse-ok flag."""
    title = collapse_ws(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1))
    text = html_to_text(F.col("html"))
    return pages.select("page_id", "url", title.alias("title"), text.alias("full_text")) \
        .withColumns({"n_chars": F.length("full_text").cast("bigint"),
                      "parse_ok": F.length("full_text") > 0})


def section_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """TX2 + TX3: one chunk per paragraph (line), the first line as header field.

    Empty paragraphs are dropped; the position is kept so chunk ids are
    stable: ``<doc_id>|<pos>`` (SF19).
    """
    parts = docs.select(id_col, "lang", "source",
                        F.substring_index(F.col(text_col), "\n", 1).alias("doc_title"),
                        F.posexplode(F.split(F.col(text_col), "\n")).alias("pos", "chunk"))
    parts = parts.filter(F.length(F.trim("chunk")) > 0)
    return parts.withColumns({
        "chunk_id": F.concat_ws("|", F.col(id_col).cast("string"), F.col("pos").cast("string")),
        # key for joins / aggregation: the pair itself, so no id or position is too large
        "chunk_key": F.struct(F.col(id_col).cast("bigint").alias("doc_id"), F.col("pos"))})


def chunk_fields(chunks: DataFrame) -> DataFrame:
    """TX4 + TX5: structured fields per chunk and the text to index."""
    c = collapse_ws(F.col("chunk"))
    n_words = F.when(F.length(c) == 0, F.lit(0)).otherwise(
        F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit(""))) + 1)
    return chunks.select(
        "chunk_id", "chunk_key", "doc_id", "pos", "lang", "source", "doc_title",
        F.regexp_extract(c, r"^[^.!?]*[.!?]?", 0).alias("first_sentence"),
        n_words.cast("bigint").alias("n_words"),
        F.length(c).cast("bigint").alias("n_chars"),
        F.concat_ws(" ", collapse_ws(F.col("doc_title")), c).alias("search_text"))


def tokens(text: Column) -> Column:
    """Lower-cased letter/digit runs (array, may hold empty strings at the ends)."""
    return F.split(F.lower(text), TOKEN_SPLIT)
