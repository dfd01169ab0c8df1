"""First-match-wins gates: a chain of rules gives a row the reason of the first that it breaks, or null.

The order of the rules shows in the result, so a gate is one CASE expression. `admit` turns a reason into the two
sides, both lazy: what is kept, and what is rejected with its reason.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions import urls as u

Rule = tuple[str, Column]

# Disclosures and extraction notes that send a text to review.
MT_NOTICE = r"(?i)(?U)\bthis\s+(?:article|story|page|text)\s+(?:has\s+been|was|is)\s+(?:automatically|machine)[ -]translated\b|\btranslated\s+(?:using|with|by)\s+(?:google\s+translate|deepl)\b"
UPDATE_MARK = r"(?i)(?U)(?:last\s+)?(?:updated|modified)(?:\s+on)?\s*:?[\s(]*"
NOTICE = r"(?i)(?U)\b(?:computer[ -]generated|machine[ -]generated|automatically\s+generated|machine\s+translation|automatically\s+translated|google\s+translate|deepl|babelfish|systran|chatgpt|gpt[ -]?[234])\b"
NEWS_NOTICE = NOTICE + r"|\b(?:automated insights|narrative science|wordsmith|heliograf|robot[ -]written|AI[ -]generated)\b"
PARSER_NOTE = r"(?i)(?U)\b(?:question\s+number\s+missing\s+in\s+hansard|possibly\s+truncated\s+question|parlparse\s+(?:error|warning)|no\s+(?:question|speaker|answer)\s+(?:found|available))\b"
ATTRIBUTION = r"(?m)^[ \t]*((?:Lord|Baroness|Earl|Viscount|The\s+(?:Lord|Earl|Viscount|Baroness|Archbishop|Bishop))[^:\n]{1,110}):[ \t]*"
PARLIAMENT_LICENSE = "https://www.parliament.uk/site-information/copyright-parliament/open-parliament-licence/"
OPEN_LICENSES = ("creativecommons.org/licenses/by/4.0/", "creativecommons.org/licenses/by-sa/4.0/")
COMPONENTS = ("ArXiv", "FreeLaw", "NIH ExPorter", "PhilPapers", "PubMed Abstracts", "PubMed Central", "StackExchange", "Wikipedia (en)")


def first_reason(rules: Sequence[Rule]) -> Column:
    """The name of the first rule whose condition holds; a condition that is null does not hold."""
    chain = None
    for name, broken in rules:
        chain = F.when(broken, name) if chain is None else chain.when(broken, name)
    return F.lit(None).cast("string") if chain is None else chain


def admit(rows: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(kept without, rejected with) the column `reason`."""
    judged = rows.withColumn("reason", reason)
    return judged.where("reason IS NULL").drop("reason"), judged.where("reason IS NOT NULL")


def _missing(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def debate_reason(cutoff_year: int, cutoff: str | None = None) -> Column:
    """Parliament rows (id, source, text, metadata.language, metadata.year): language, source, date, year, cutoff, text."""
    found = F.regexp_extract(F.coalesce(F.col("id").cast("string"), F.lit("")), r"\d{4}-\d{2}-\d{2}", 0)
    date, year = found.try_cast("date"), F.col("metadata.year").try_cast("int")
    rules = [
        ("language_not_explicitly_english", _missing(F.col("metadata.language")) != "en"),
        ("source_requires_translation_provenance_review", ~_missing(F.col("source")).rlike("^uk-hansard-(commons|lords)-[a-z-]+$")),
        ("missing_document_date", found == ""),
        ("invalid_date_or_year", date.isNull() | year.isNull()),
        ("date_year_disagreement", F.year(date) != year),
        ("publication_after_cutoff", year > cutoff_year),
        ("empty_text", t.is_blank(F.col("text"))),
    ]
    if cutoff:
        rules.append(("publication_after_cutoff", date > F.lit(cutoff).cast("date")))
    return first_reason(rules)


def debate_date() -> Column:
    return F.regexp_extract(F.col("id").cast("string"), r"\d{4}-\d{2}-\d{2}", 0).try_cast("date")


def story_reason(cutoff: str) -> Column:
    """SGML stories (id, type, has_body, text): type, id, date, cutoff, body, text."""
    written = F.regexp_extract(F.col("id"), r"^[A-Z]+_ENG_(\d{8})\.\d+$", 1)
    date = story_date()
    return first_reason([
        ("non_story", _missing(F.col("type")) != "story"),
        ("invalid_story_id", written == ""),
        ("invalid_story_date", date.isNull()),
        ("publication_after_cutoff", date > F.lit(cutoff).cast("date")),
        ("missing_story_text", ~F.col("has_body")),
        ("empty_story_text", t.is_blank(F.col("text"))),
    ])


def story_date() -> Column:
    written = F.regexp_extract(F.col("id"), r"^[A-Z]+_ENG_(\d{8})\.\d+$", 1)
    return F.regexp_replace(written, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3").try_cast("date")


def component_reason(snapshot: str, cutoff: str, allowed: Sequence[str] = COMPONENTS) -> Column:
    """Rows of a mixed dump (text, meta.pile_set_name): component, snapshot date, text."""
    return first_reason([
        ("pile_component_not_allowlisted", ~F.coalesce(F.col("meta.pile_set_name").isin(*allowed), F.lit(False))),
        ("snapshot_after_cutoff", F.lit(snapshot).cast("date") > F.lit(cutoff).cast("date")),
        ("empty_text", t.is_blank(F.col("text"))),
    ])


@dataclass(frozen=True)
class NewsPolicy:
    minimum_words: int = 400
    publication_cutoff: str = "2021-12-31"
    source_hosts: dict[str, str] = field(default_factory=dict)
    publishers: tuple[str, ...] = ()
    dated_url_sources: tuple[str, ...] = ()
    english_confidence_minimum: float = 0.8


def news_dates(policy: NewsPolicy, extracted: Column) -> Column:
    """struct(date, updated, evidence, reason) of news rows (date, created, source, metadata.url).

    `extracted` is true for rows whose date field is an extracted ISO date; the others carry a free-text publication field,
    with an optional update mark, that must agree with a dated URL.
    """
    created = _missing(F.col("created"))
    mark = F.regexp_instr(created, F.lit(UPDATE_MARK))
    marked = mark > 0
    published = F.when(marked, F.substr(created, F.lit(1), mark - 1)).otherwise(created)
    rest = F.substr(created, mark + F.length(F.regexp_extract(created, UPDATE_MARK, 0)))
    dates = F.array_sort(F.array_distinct(t.explicit_dates(published)))
    in_url = u.dated_path(F.col("metadata.url"))
    use_url = F.coalesce(in_url["found"] & F.col("source").isin(*(policy.dated_url_sources or ("",))), F.lit(False))
    first = F.try_element_at(dates, F.lit(1))
    url_date = F.when(use_url, in_url["date"])
    date = F.coalesce(first, url_date)
    updated = F.when(marked, F.array_max(t.explicit_dates(rest)))
    reason = first_reason([
        ("ambiguous_publication_dates", F.size(dates) > 1),
        ("invalid_publication_date_in_url", use_url & in_url["date"].isNull()),
        ("publication_date_url_conflict", first != url_date),
        ("missing_or_unparsed_publication_date", date.isNull()),
        ("unparsed_explicit_update_date", marked & updated.isNull()),
        ("update_precedes_publication", updated < date),
    ])
    evidence = F.when(first.isNotNull(), "Parsed source publication field").otherwise("Source-specific dated article URL; revision timestamp absent")
    iso = F.substring(F.col("date"), 1, 10).try_cast("date")
    none = F.lit(None).cast("date")
    plain = F.struct(iso.alias("date"), none.alias("updated"), F.lit("Upstream extracted publication-date field; capture timestamp absent").alias("evidence"), F.when(iso.isNull(), "missing_or_invalid_publication_date").alias("reason"))
    parsed = F.struct(date.alias("date"), updated.alias("updated"), evidence.alias("evidence"), reason.alias("reason"))
    return F.when(extracted, plain).otherwise(parsed)


def news_gate(rows: DataFrame, policy: NewsPolicy, open_licensed: Column) -> DataFrame:
    """News rows with canonical_url, publisher, license, whitespace_words, dated (struct) and reason.

    `open_licensed` is true for rows of a collection with declared open licences and known source hosts; the others must come from a
    listed publisher. Cheap rules come first in the chain; nothing is evaluated in Python.
    """
    url = F.coalesce(F.col("url"), F.col("metadata.url"))
    actual = u.host(url)
    expected = u.mapped_host(F.col("source"), policy.source_hosts)
    publisher = F.when(open_licensed, expected).otherwise(u.first_matching_host(actual, policy.publishers))
    license = F.when(open_licensed, F.coalesce(F.col("metadata.license"), F.lit("unknown"))).otherwise("unknown")
    declared = reduce(lambda a, b: a | b, [F.contains(license, F.lit(x)) for x in OPEN_LICENSES])
    named = u.host(F.concat(F.lit("https://"), F.col("domain")))
    rows = rows.withColumns({"canonical_url": u.canonical_url(url), "publisher": publisher, "license": license, "whitespace_words": t.word_count(F.col("text")), "dated": news_dates(policy, ~open_licensed)})
    cutoff = F.lit(policy.publication_cutoff).cast("date")
    edges = F.concat(F.substring("text", 1, 1500), F.lit("\n"), F.right("text", F.lit(1000)))
    return rows.withColumn("reason", first_reason([
        ("empty_text", t.is_blank(F.col("text"))),
        ("document_too_short_in_words", F.col("whitespace_words") < policy.minimum_words),
        ("invalid_article_url", actual.isNull()),
        ("source_host_mismatch_or_unreviewed_source", open_licensed & F.coalesce(~u.host_matches(actual, expected), F.lit(True))),
        ("unexpected_or_missing_declared_license", open_licensed & ~declared),
        ("publisher_requires_review", ~open_licensed & F.col("publisher").isNull()),
        ("missing_or_invalid_domain", ~open_licensed & named.isNull()),
        ("domain_url_mismatch", ~open_licensed & (named != actual)),
        ("homepage_not_article", u.path(F.col("canonical_url")) == "/"),
        *[(r, F.col("dated.reason") == r) for r in ("missing_or_invalid_publication_date", "ambiguous_publication_dates", "invalid_publication_date_in_url", "publication_date_url_conflict", "missing_or_unparsed_publication_date", "unparsed_explicit_update_date", "update_precedes_publication")],
        ("publication_after_cutoff", F.col("dated.date") > cutoff),
        ("explicit_update_after_cutoff", F.col("dated.updated") > cutoff),
        ("explicit_machine_translation_notice_requires_review", edges.rlike(MT_NOTICE)),
    ]))


def english_reason(confidence: Column, minimum: float = 0.8) -> Column:
    """confidence: the least one of a text's samples, see operators.language."""
    return first_reason([("english_language_check_requires_review", confidence < minimum)])


@dataclass(frozen=True)
class CorePolicy:
    dataset: str = "hansard"
    source: str = "uk-hansard-lords-written-answers"
    publisher: str = "UK Parliament"
    publication_cutoff: str = "2010-12-31"
    minimum_words: int = 400
    maximum_words: int = 3000
    minimum_distinct_named_participants: int = 2
    maximum_digit_token_fraction: float = 0.08
    maximum_numeric_line_fraction: float = 0.05
    maximum_tabular_line_fraction: float = 0.05
    minimum_alphabetic_token_fraction: float = 0.75


def source_reason(policy: CorePolicy, row: str = "") -> Column:
    """The source gate of the strict core, on columns or, with `row`, on the fields of a struct."""
    c = lambda name: F.col(f"{row}.{name}" if row else name)
    date = c("publication_date").cast("string").try_cast("date")
    identity = F.regexp_extract(_missing(c("original_id")), r"^lordswrans(\d{4}-\d{2}-\d{2})[a-z]*$", 1)
    same = (c("dataset") == policy.dataset) & (c("source") == policy.source) & (c("publisher") == policy.publisher)
    english = (c("language") == "en") & (c("metadata.language") == "en")
    return first_reason([
        ("source_outside_strict_core", ~F.coalesce(same, F.lit(False))),
        ("missing_english_provenance", ~F.coalesce(english, F.lit(False))),
        ("missing_or_invalid_publication_date", date.isNull()),
        ("date_id_year_disagreement", (identity != date.cast("string")) | (_missing(c("metadata.year").cast("string")) != F.year(date).cast("string"))),
        ("publication_after_strict_cutoff", date > F.lit(policy.publication_cutoff).cast("date")),
        ("known_revision_after_strict_cutoff", c("last_known_update_date") > policy.publication_cutoff),
        ("known_text_version_after_strict_cutoff", c("text_version_date") > policy.publication_cutoff),
        ("missing_or_disputed_parliamentary_license", ~F.contains(_missing(c("license")), F.lit(PARLIAMENT_LICENSE)) | (_missing(c("license_review_status")) != "")),
        ("unexpected_authorship_or_engine", (_missing(c("authorship")) != "human_candidate") | c("binary_target").isNotNull() | (_missing(c("engine")) != "")),
    ])


def participants(text: Column) -> Column:
    """Distinct names in attributions, sorted."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(ATTRIBUTION), F.lit(1)), F.trim)))


def asked_and_answered(text: Column) -> Column:
    """Some attribution opens a question and a later one doesn't: what follows each attribution is looked at in order."""
    pieces = F.regexp_extract_all(text, F.lit(ATTRIBUTION + r"((?i:asked\b|To\s+ask\b)?)"), F.lit(2))
    asks = F.transform(pieces, lambda x: x != "")
    first = F.array_position(asks, F.lit(True))
    return F.when(first > 0, F.exists(F.slice(asks, F.when(first > 0, first).otherwise(1).cast("int"), F.size(asks)), lambda x: ~x)).otherwise(F.lit(False))


def strict_core_reason(policy: CorePolicy) -> Column:
    """The strict gate on passages joined to their parent (struct column `parent`).

    A passage that its own source gate keeps fails the job where its parent's doesn't, where it is no slice of the parent, or where its hash or word count is wrong.
    """
    metrics = t.prose_metrics(F.col("text"))
    words = t.word_count(F.col("text"))
    limits = [(f"prose_screen:{k}", metrics[k] > getattr(policy, f"maximum_{k}")) for k in ("digit_token_fraction", "numeric_line_fraction", "tabular_line_fraction")]
    body = F.col("parent.text")
    own = t.text_slice(body, F.col("character_range")[0], F.col("character_range")[1])
    wrong = ~F.coalesce((own == F.col("text")) & (F.col("parent.split_group") == F.col("split_group")) & (F.col("parent.split") == F.col("split")), F.lit(False))
    source = source_reason(policy)
    disagree = F.when(source.isNull() & source_reason(policy, "parent").isNotNull(), F.raise_error(F.lit("Passage and parent source policy disagree")).cast("string"))
    differs = F.when(source.isNull() & wrong, F.raise_error(F.lit("Passage body or partition differs from parent")).cast("string"))
    before = first_reason([
        ("parent_generation_or_translation_mention_requires_review", body.rlike(NOTICE)),
        ("parent_extraction_annotation_requires_review", body.rlike(PARSER_NOTE)),
        ("outside_word_bounds", ~words.between(policy.minimum_words, policy.maximum_words)),
    ])
    intact = F.coalesce((F.col("text_sha256") == t.text_hash(F.col("text"))) & (F.col("whitespace_words") == words), F.lit(False))
    broken = F.when(~intact, F.raise_error(F.lit("Passage integrity differs")).cast("string"))
    return F.coalesce(source, disagree, differs, before, broken, first_reason([
        ("insufficient_named_participants", F.size(participants(F.col("text"))) < policy.minimum_distinct_named_participants),
        ("no_explicit_named_question_and_answer", ~asked_and_answered(F.col("text"))),
        *limits,
        ("prose_screen:alphabetic_token_fraction", metrics["alphabetic_token_fraction"] < policy.minimum_alphabetic_token_fraction),
    ]))


def diverse_news_reason(publishers: Sequence[str], publication_cutoff: str, update_cutoff: str) -> Column:
    """Publisher and date, known update, notices, named byline (text, publisher, publication_date, metadata.author)."""
    return first_reason([
        ("publisher_or_date_outside_news_policy", ~F.coalesce(F.col("publisher").isin(*publishers), F.lit(False)) | (F.col("publication_date") > publication_cutoff)),
        ("known_news_update_after_cutoff", F.col("last_known_update_date") > update_cutoff),
        ("generation_translation_or_extraction_mention_requires_review", F.col("text").rlike(NEWS_NOTICE) | F.col("text").rlike(PARSER_NOTE)),
        ("missing_named_article_byline", t.byline(F.col("text"), F.col("metadata.author")).isNull()),
    ])


def prose_ok(text: Column, policy: CorePolicy) -> Column:
    m = t.prose_metrics(text)
    return (m["alphabetic_token_fraction"] >= policy.minimum_alphabetic_token_fraction) & (m["digit_token_fraction"] <= policy.maximum_digit_token_fraction) & (m["numeric_line_fraction"] <= policy.maximum_numeric_line_fraction)


def post_reason() -> Column:
    """Hydrated posts joined to their index (known, conflict, role, meta_lang, lang, reply_to, media_only, original_text)."""
    return first_reason([
        ("id_not_in_pinned_release", ~F.col("known")),
        ("conflicting_release_metadata", F.col("conflict")),
        ("participant_authorship_unresolved", F.coalesce(F.col("role"), F.lit(0)) != 1),
        ("not_english_or_language_conflict", (_missing(F.col("meta_lang")) != "en") | (F.coalesce("lang", F.lit("en")) != "en")),
        ("not_a_text_assistant_reply", F.col("reply_to").isNull() | (F.coalesce(F.col("media_only"), F.lit(-1)) != 0)),
        ("empty_original_text", t.is_blank(F.col("original_text"))),
        ("repost_text", F.col("original_text").rlike(rf"^[{t.SPACE}]*RT @")),
    ])


def account_class_target() -> Column:
    """Target 0, 1 or null of a post by account and class; an illegal combination fails the job."""
    account, kind = F.col("`account.type`"), F.col("class_type")
    return (
        F.when((account == "human") & (kind == "human"), 0)
        .when((account == "bot") & kind.isin("gpt2", "rnn"), 1)
        .when((account == "bot") & (kind == "others"), F.lit(None))
        .otherwise(F.raise_error(F.lit("Unexpected class/account combination")).cast("int"))
    )


def tail_reason(minimum_words: int, text: Column) -> Column:
    return first_reason([
        ("body_below_minimum_after_tail_cleanup", t.word_count(text) < minimum_words),
        ("possible_explicit_mt_disclosure_requires_review", text.rlike(MT_NOTICE)),
    ])


def genre_members(rows: DataFrame, genres: Sequence[str], genre: str = "genre") -> DataFrame:
    return rows.where(F.col(genre).isin(*genres))
