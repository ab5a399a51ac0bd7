"""Decision rules as Columns: routing, validation, candidate flags, visual evidence, completeness, canonical choice."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliary.functions import text as X

# Fixed values of the image rules.
DARK_CUTOFF, MOST_BLANK_DARK = 250, 25


@dataclass(frozen=True)
class RoutingRules:
    least_characters: int = 40
    least_alphanumeric: float = 0.35
    full_page_images: bool = True
    ocr_reasons: tuple[str, ...] = field(default=("scanned", "garbled", "no-text", "embedded-images"))


@dataclass(frozen=True)
class ValidationRules:
    most_replacement_characters: int = 0
    least_confidence: float = 0.75
    uneven_tables: bool = True
    numeric: bool = True


def flags(*conditions: tuple[Column, str]) -> Column:
    """Names of the conditions that hold, in order."""
    return F.filter(F.array(*(F.when(c, F.lit(name)) for c, name in conditions)), lambda x: x.isNotNull())


def route_reasons(text: Column, complexity_reasons: Column, full_page_image: Column, rules: RoutingRules = RoutingRules()) -> Column:
    own = X.stripped(F.coalesce(text, F.lit("")))
    fixed = flags(
        (F.lit(rules.full_page_images) & F.coalesce(full_page_image, F.lit(False)), "full-page-image"),
        (own == "", "empty-native-text"),
        ((own != "") & (F.length(own) < rules.least_characters), "too-little-native-text"),
        ((own != "") & (X.alphanumeric_ratio(own) < rules.least_alphanumeric), "low-alphanumeric-ratio"),
    )
    given = F.array_sort(F.array_intersect(F.coalesce(complexity_reasons, F.array().cast("array<string>")), F.array(*map(F.lit, rules.ocr_reasons))))
    return F.array_distinct(F.concat(fixed, given))


def route(reasons: Column) -> Column:
    return F.when(F.size(reasons) > 0, "ocr").otherwise("native")


def page_flags(text: Column, markdown: Column, route_: Column, confidence: Column, native_text: Column, rules: ValidationRules = ValidationRules()) -> Column:
    t = F.coalesce(text, F.lit(""))
    ocr = route_ == "ocr"
    return flags(
        (X.is_blank(t), "empty-text"),
        (X.replacement_characters(t) > rules.most_replacement_characters, "replacement-characters"),
        (ocr & (confidence < rules.least_confidence), "low-ocr-confidence"),
        (F.lit(rules.uneven_tables) & X.has_uneven_table(F.coalesce(markdown, F.lit(""))), "inconsistent-table-width"),
        (F.lit(rules.numeric) & ocr & ~X.is_blank(native_text) & ~X.same_multiset(X.numbers(t), X.numbers(F.coalesce(native_text, F.lit("")))), "native-ocr-numeric-disagreement"),
    )


def candidate_flags(text: Column, reference: Column, rules: ValidationRules = ValidationRules()) -> Column:
    t = F.coalesce(text, F.lit(""))
    return flags(
        (X.is_blank(t), "empty-text"),
        (X.replacement_characters(t) > rules.most_replacement_characters, "replacement-characters"),
        (F.lit(rules.uneven_tables) & X.has_uneven_table(t), "inconsistent-table-width"),
        (F.lit(rules.numeric) & ~X.is_blank(reference) & ~X.same_multiset(X.content_numbers(t), X.content_numbers(F.coalesce(reference, F.lit("")))), "candidate-numeric-disagreement"),
    )


def page_status(found: Column) -> Column:
    return F.when(F.size(found) > 0, "review").otherwise("accepted")


def ink(pixels: Column) -> tuple[Column, Column, Column]:
    """(pixels, dark pixels, visually blank) of an array of grey values."""
    dark = F.size(F.filter(pixels, lambda p: p < DARK_CUTOFF))
    return F.size(pixels).cast("long"), dark.cast("long"), dark <= MOST_BLANK_DARK


def valid_metrics(pixels: Column, dark: Column, cutoff: Column, blank: Column) -> Column:
    said = blank.isNotNull() & (cutoff == DARK_CUTOFF) & (dark >= 0) & (pixels > 0) & (dark <= pixels) & (blank == (dark <= MOST_BLANK_DARK))
    return F.coalesce(said, F.lit(False))


def verified_blank(flag: Column, pixels: Column, dark: Column, cutoff: Column, blank: Column) -> Column:
    return F.coalesce(flag & valid_metrics(pixels, dark, cutoff, blank) & blank, F.lit(False))


def visual_flags(blank: Column, local_empty: Column, model_text: Column, ocr_text: Column) -> Column:
    return flags(
        (blank & ~local_empty, "local-nonempty-on-blank"),
        (blank & ~X.is_blank(model_text), "model-nonempty-on-blank"),
        (blank & ~X.is_blank(ocr_text), "ocr-nonempty-on-blank"),
        (~blank & ocr_text.isNotNull() & X.is_blank(ocr_text), "ocr-empty-on-visible"),
    )


def triad(local: Column, ocr: Column, model: Column) -> Column:
    """How three multisets of numbers agree; null if all are empty."""
    a, b, c = (F.array_sort(x) for x in (local, ocr, model))
    some = F.size(a) + F.size(b) + F.size(c) > 0
    return F.when(
        some,
        F.when((a == b) & (b == c), "all_equal").when(a == c, "local_model_equal").when(a == b, "local_ocr_equal").when(b == c, "model_ocr_equal").otherwise("all_different"),
    )


def skip_reason(s: dict[str, Column]) -> Column:
    """Why a scope has nothing to publish; s: columns of a scope's status."""
    complete = s["census_status"] == "complete"
    html = (s["acquired_documents"] == 0) & (s["records"] > 0) & (s["failed"] == s["records"]) & (s["unsupported_html"] == s["records"])
    return F.when(complete & (s["records"] == 0), "no records").when(complete & html, "all originals are HTML")


def _acquired(s: dict[str, Column]) -> Column:
    return (s["census_status"] == "complete") & (s["acquired_documents"] > 0) & (s["processed_documents"] == s["acquired_documents"]) & (s["failed"] == s["unsupported_html"])


def _all_seen(s: dict[str, Column]) -> Column:
    return (s["discovered"] == 0) & (s["downloaded"] + s["unsupported_html"] == s["records"])


def publication_ready(s: dict[str, Column], limited: bool = False, all_pages: bool = True) -> Column:
    return F.coalesce(_acquired(s) & (F.lit(limited) | _all_seen(s)) & F.lit(all_pages) & (s["pages"] > 0) & (s["adjudicated_pages"] == s["pages"]), F.lit(False))


def session_complete(s: dict[str, Column], path: str, all_pages: bool = True, unlimited: bool = True, adjudicated: bool = True) -> Column:
    allowed = F.lit(bool(path) and all_pages and unlimited and adjudicated)
    return F.coalesce(_acquired(s) & _all_seen(s) & (s["records"] > 0) & (s["pages"] > 0) & (s["adjudicated_pages"] == s["pages"]) & allowed, F.lit(False))


def canonical(local_text: Column, model_text: Column, has_model: Column, blank_evidence: Column, policy: Column | str) -> tuple[Column, Column]:
    """(text, source): the local text, the model's under policy 'model' if there is one, or '' for a page verified blank."""
    by_model = (policy if isinstance(policy, Column) else F.lit(policy)).eqNullSafe("model") & has_model
    blank = has_model & blank_evidence
    return F.when(blank, "").when(by_model, F.coalesce(model_text, F.lit(""))).otherwise(local_text), F.when(blank, "visual:verified-blank").when(by_model, "model").otherwise("local")


def canonical_violations(model_text: Column, has_model: Column, blank_evidence: Column, metrics_ok: Column, policy: Column | str) -> Column:
    """What forbids a canonical choice: names of the conditions, none if the choice may be made."""
    by_model = (policy if isinstance(policy, Column) else F.lit(policy)).eqNullSafe("model")
    return flags(
        (has_model & model_text.isNull(), "missing-transcript"),
        (has_model & ~metrics_ok, "invalid-metrics"),
        (by_model & has_model & X.is_blank(model_text) & ~blank_evidence, "unproven-empty-model-text"),
    )
