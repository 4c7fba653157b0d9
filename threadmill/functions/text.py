"""Text functions of the curation pipeline, as JVM expressions.

Regular expressions spell out character classes, since engines disagree on the short ones.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[ \t\r\n\f\x0B]"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
#: Replacements of the redaction operator, in order (fixed values).
REDACTIONS = (
    ("[0-9]{3}-[0-9]{2}-[0-9]{4}", "[SSN]"),
    ("[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}", "[CARD]"),
    (r"\+?[0-9]{1,3}[ .-]?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}", "[PHONE]"),
    (r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}", "10.0.0.1"),
    (EMAIL, "[EMAIL]"),
)


def synthetic_id(raw: Column) -> Column:
    return F.concat(F.lit("synthetic-"), F.substring(F.sha2(raw, 256), 1, 16), F.lit("@generated"))


def message_id_or_synth(id_: Column, raw: Column) -> Column:
    """The header's id, or one made from the message's hash."""
    return F.coalesce(F.when(id_ != "", id_), synthetic_id(raw))


def normalize_subject(subject: Column) -> Column:
    """Lower case without one reply or forward prefix at the start of each line."""
    bare = F.regexp_replace(F.coalesce(subject, F.lit("")), r"(?im)^(re|fwd?|aw):" + SPACE + "*", "")
    return F.lower(F.regexp_replace(bare, f"^{SPACE}+|{SPACE}+$", ""))


def derive_thread_id(references: Column, in_reply_to: Column, subject: Column, message_id: Column) -> Column:
    """First reference, else the answered message, else a hash of the subject, else the message itself."""
    norm = normalize_subject(subject)
    by_subject = F.when(norm != "", F.concat(F.lit("subject-"), F.substring(F.sha2(norm, 256), 1, 16)))
    return F.coalesce(F.try_element_at(references, F.lit(1)), F.when(in_reply_to != "", in_reply_to), by_subject, message_id)


def stamp_cohort(date: Column, modified: Column, override: str | None = None) -> Column:
    """Month of the message: the given one, that of its date, or that of its file."""
    return F.coalesce(F.lit(override), F.date_format(date, "yyyy-MM"), F.date_format(modified, "yyyy-MM"))


def length_bucket(length: Column) -> Column:
    n = F.coalesce(length, F.lit(0))
    return F.when(n <= 512, "short").when(n <= 2048, "medium").otherwise("long")


def text_coalesce(*cols: Column) -> Column:
    return F.coalesce(*cols, F.lit(""))


def row_id_fallback(message_id: Column, id_: Column, split: Column, position: Column) -> Column:
    return F.coalesce(message_id, id_, F.concat(split, F.lit("_"), position.cast("string")))


def _lines_without(text: Column, *patterns: str) -> Column:
    def keep(line: Column) -> Column:
        bad = line.rlike(patterns[0])
        for p in patterns[1:]:
            bad = bad | line.rlike(p)
        return ~bad

    return F.array_join(F.filter(F.split(text, "\n"), keep), "\n")


def strip_quotes(text: Column) -> Column:
    """Lines that quote (``>``) or introduce a quotation are dropped."""
    return _lines_without(text, f"^{SPACE}*>", f"(?i)^{SPACE}*On .+<[^>]+> wrote:")


def dequote(text: Column) -> Column:
    """Retrieval's variant: also drops forwarded headers, and trims."""
    kept = _lines_without(text, f"^{SPACE}*>", "(?i)^On .+ wrote:", "(?i)^From:.+Sent:")
    return F.regexp_replace(kept, f"^{SPACE}+|{SPACE}+$", "")


def normalize_content(text: Column, quotes: bool = True) -> Column:
    """Lower case, one space for each run of white space, trimmed."""
    body = strip_quotes(text) if quotes else text
    return F.trim(F.regexp_replace(F.lower(body), SPACE + "+", " "))


def tokens(content: Column) -> Column:
    """Words of normalised content; none for empty content."""
    return F.when(content == "", F.array().cast("array<string>")).otherwise(F.split(content, " "))


def shingles(words: Column, width: int = 5) -> Column:
    """Distinct n-grams of a token array; none for fewer tokens than ``width``."""
    n = F.size(words)
    grams = F.transform(F.sequence(F.lit(1), F.greatest(n - (width - 1), F.lit(1))), lambda i: F.array_join(F.slice(words, i, width), " "))
    return F.when(n >= width, F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two arrays as sets; two empty ones have 0."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def bm25_tokens(text: Column) -> Column:
    """Runs of a-z and 0-9 that no other word character touches."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}_]+"), lambda w: w.rlike("^[a-z0-9]+$"))


def parse_references(header: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(header, F.lit("")), F.lit("<([^>]+)>"), F.lit(1))


def strip_brackets(id_: Column) -> Column:
    return F.regexp_replace(id_, "^<|>$", "")


def construct_query(subject: Column, text: Column, lines: int = 3) -> Column:
    """Subject and the first lines that neither quote nor introduce a quotation."""
    kept = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: ~(x.rlike(f"^{SPACE}*[>|]") | x.rlike("^On .* wrote:")))
    return F.regexp_replace(F.concat_ws(" ", subject, F.array_join(F.slice(kept, 1, lines), " ")), f"^{SPACE}+|{SPACE}+$", "")


def pseudonymize(value: Column, salt: str, kind: str = "email", prefix: str = "user_") -> Column:
    """``user_`` and twelve digits of a salted hash; null for null and empty values."""
    key = F.sha2(F.concat_ws(":", F.sha2(F.lit(salt), 256), F.lit(kind), value), 256)
    return F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(prefix), F.substring(key, 1, 12)))


def redact_pii(text: Column) -> Column:
    for pattern, label in REDACTIONS:
        text = F.regexp_replace(text, pattern, label.replace("$", r"\$"))
    return text


def emails(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({EMAIL})"), F.lit(1))


def eval_text(subject: Column, body: Column) -> Column:
    return F.concat(F.lit("Subject: "), F.coalesce(subject, F.lit("")), F.lit("\n\n"), F.coalesce(body, F.lit("")))


def build_prompt(snippets: Column, question: Column) -> Column:
    """Numbered snippets and a question."""
    numbered = F.transform(snippets, lambda s, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), s))
    return F.concat(F.array_join(numbered, "\n\n"), F.lit("\n\nQuestion: "), question)


def chunks(text: Column, size: int = 400, overlap: int = 50) -> Column:
    """Overlapping runs of white-space tokens; none for text without tokens."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than size")
    words = tokens(F.trim(F.regexp_replace(text, SPACE + "+", " ")))
    step = size - overlap
    n = F.size(words)
    starts = F.sequence(F.lit(0), F.greatest(F.ceil((n - overlap) / F.lit(step)).cast("int"), F.lit(1)) - 1)
    made = F.transform(starts, lambda i: F.array_join(F.slice(words, i * step + 1, size), " "))
    return F.when(n > 0, made).otherwise(F.array().cast("array<string>"))


def compare_threshold(value: Column, comparison: Column, threshold: Column) -> Column:
    """gt (also when null), lt, gte or lte; anything else is false."""
    kind = F.coalesce(comparison, F.lit("gt"))
    hit = F.when(kind == "gt", value > threshold).when(kind == "lt", value < threshold).when(kind == "gte", value >= threshold).when(kind == "lte", value <= threshold).otherwise(F.lit(False))
    return F.coalesce(hit, F.lit(False))


def score_checkpoint(perplexity: Column, accuracy: Column) -> Column:
    return accuracy / perplexity


def improvement_pct(base: Column, tuned: Column) -> Column:
    return (base - tuned) / base * 100
