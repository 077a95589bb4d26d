"""Text expressions: tokens, set similarity, cleaning. All built in, except full HTML unescaping."""

from __future__ import annotations

import html

import pandas as pd
import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# --- fixed values: stop words of title comparison and of headline clustering --
TITLE_STOP = (
    "a an and are as at be by for from has have in into is it its of on or over says said the to "
    "up with new its via vs after amid will than that this what how why who"
).split()
CLUSTER_STOP = (
    "a an and are as at be by for from has have in into is it its of on or over says the to up with new "
    "after amid will than that this what how why who report reports"
).split()

# --- fixed values: word patterns ----------------------------------------------
WORD = r"[a-z0-9]+(?:[.\-][a-z0-9]+)*"
CJK = "[一-鿿]"
ELLIPSIS = "…"
SENTENCE_BREAK = r"(?<=[.!?])\s+(?=[A-Z0-9\"'“(])"

# --- fixed values: topical keyword patterns -------------------------------------
TOPICAL_WORDS = (
    r"\b(AI|A\.I\.|AGI|artificial intelligence|machine learning|LLMs?|GPT[-\w.]*|chatbots?|OpenAI|Anthropic|Claude|"
    r"Gemini|DeepMind|Llama|Mistral|Grok|xAI|Copilot|Nvidia|GPUs?|HBM|TPU|semiconductors?|chips?|"
    r"data ?cent(?:er|re)s?|DeepSeek|Qwen|Kimi|Moonshot|Zhipu|MiniMax|agents?|agentic|robot\w*|neural|transformer|"
    r"inference|foundation models?|diffusion|multimodal)\b"
)
TOPICAL_TERMS = (
    "人工智能|大模型|智能体|算力|芯片|机器人|模型|具身|英伟达|昇腾|通义|千问|豆包|智谱|月之暗面|深度求索|DeepSeek"
)


def _literals(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in dict.fromkeys(values)])


def title_tokens(title: Column) -> Column:
    """Distinct lower-case words (inner dots and hyphens kept) and single CJK characters."""
    words = F.regexp_extract_all(F.lower(title), F.lit(f"{WORD}|{CJK}"), F.lit(0))
    return F.array_except(words, _literals(TITLE_STOP))


def cluster_tokens(title: Column) -> Column:
    """Distinct words longer than one character, and bigrams of every CJK run."""
    words = F.filter(
        F.array_except(F.regexp_extract_all(F.lower(title), F.lit(WORD), F.lit(0)), _literals(CLUSTER_STOP)),
        lambda w: F.length(w) > 1,
    )
    runs = F.filter(F.regexp_extract_all(title, F.lit(CJK + "+"), F.lit(0)), lambda r: F.length(r) > 1)
    bigrams = F.flatten(
        F.transform(runs, lambda r: F.transform(F.sequence(F.lit(1), F.length(r) - 1), lambda i: F.substring(r, i, 2)))
    )
    return F.array_distinct(F.concat(words, bigrams))


def jaccard(a: Column, b: Column) -> Column:
    """|a and b| / |a or b| of two distinct arrays; 0 when both are empty."""
    shared = F.size(F.array_intersect(a, b))
    return F.coalesce(F.try_divide(shared, F.size(a) + F.size(b) - shared), F.lit(0.0))


@F.pandas_udf(StringType())
def html_unescape(text: pd.Series) -> pd.Series:
    """All HTML entities; Spark has no built-in for it."""
    return text.map(html.unescape, na_action="ignore")


def clean_text(raw: Column, limit: int | None = None, unescape=html_unescape) -> Column:
    """Tags to blanks, then entities resolved, blanks squeezed, cut at `limit` with an ellipsis."""
    text = F.regexp_replace(F.coalesce(raw, F.lit("")), "<[^>]+>", " ")
    text = F.trim(F.regexp_replace(unescape(text), r"(?U)\s+", " "))
    if limit is None:
        return text
    short = F.concat(F.rtrim(F.substring(text, 1, limit - 1)), F.lit(ELLIPSIS))
    return F.when(F.length(text) <= limit, text).otherwise(short)


def is_topical(text: Column, strict: bool = False) -> Column:
    """Topical keyword filter. The default also accepts a bare "ai" inside any word; `strict` does not."""
    terms = TOPICAL_TERMS if strict else TOPICAL_TERMS + "|AI"
    return text.rlike(f"(?iuU)(?:{TOPICAL_WORDS}|{terms})")


def first_sentence(text: Column) -> Column:
    """Up to the first . ! or ? that is followed by a blank and a capital, digit or quote."""
    return F.element_at(F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), SENTENCE_BREAK, 2), 1)


#: Stands before every place of a text where a keyword may start; no text has it by custom.
MARK = "\u0001"
_STARTS = r"(?s)(?<![a-z0-9])(?=.)"


def marked(text: Column) -> Column:
    """Lower-cased text with a mark at every place that does not follow a letter or digit of a-z, 0-9. A keyword marked in the
    same way (`marked_keyword`) occurs in it exactly if the keyword occurs at such a place: one pattern for any number of
    keywords, which are then plain searches."""
    return F.regexp_replace(F.lower(text), _STARTS, MARK)


def marked_keyword(keyword: str) -> str:
    return re.sub(_STARTS, MARK, keyword.lower())


def hits_in_marked(text: Column, keywords: list[str]) -> Column:
    """The keywords that occur in a text that is `marked`, in the given order."""
    found = [F.when(F.contains(text, F.lit(marked_keyword(k))), F.lit(k)) for k in keywords]
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def keyword_hits(text: Column, keywords: list[str]) -> Column:
    """The keywords that occur in `text` at a word start, in the given order: a row-local projection for a few keywords
    (`learn.keyword_matches` takes a table of many)."""
    return hits_in_marked(marked(text), keywords)
