"""Record types, fixed vocabularies and the numbers that stages share."""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, floor

from pyspark.sql.types import IntegerType, StringType, StructField, StructType

FIELDS = (
    "id status page_url domain sector image_url image_coord_space image_svg image_file image_sha256 implementation element_role "
    "element_html surrounding_text observed_alt accessible_name accessible_name_source category subtype retrieved "
    "review_verdict review_reason alt_quality"
).split()
ITEM = StructType([StructField(f, IntegerType() if f == "category" else StringType()) for f in FIELDS])
EXPORTED = (
    "id image_file image_url element_html observed_alt page_url element_role surrounding_text image_coord_space domain sector "
    "implementation category subtype accessible_name accessible_name_source retrieved"
).split()
#: Name in the record -> name in a reviewer's batch, in the batch's order.
BATCH_INPUT = {
    "id": "item_id", "image_file": "image_file", "image_url": "image_url", "image_coord_space": "image_coord_space", "page_url": "page_url",
    "implementation": "implementation", "element_role": "element_role", "element_html": "element_html", "surrounding_text": "surrounding_text",
    "observed_alt": "observed_alt", "accessible_name": "accessible_name", "accessible_name_source": "accessible_name_source",
    "category": "proposed_category", "subtype": "proposed_subtype",
}
VERDICT = StructType([StructField(f, StringType()) for f in ("item_id", "verdict", "alt_quality", "reason", "subtype")])

#: Sub-types and their categories, and the other vocabularies.
SUBTYPES = {
    "linked-standalone-logo": 1,
    "standalone-navigational-link": 1,
    "form-control-or-image-button": 2,
    "action-or-toggle-icon": 2,
    "functional-non-unicode-emoji": 3,
    "linked-complex-graphic-or-image-map": 4,
    "structural-break-or-reader-control": 5,
}
STATUSES = ("unreviewed", "ready", "dropped")
IMPLEMENTATIONS = {"img": "img", "svg": "inline-svg", "input": "input-image", "area": "area"}
ELEMENT_ROLES = ("link", "button", "input-image", "area", "custom")
NAME_SOURCES = ("alt", "aria-label", "aria-labelledby", "title", "svg-title", "control-text")
VERDICTS, QUALITIES = ("keep", "drop"), ("good", "weak", "wrong")
SECTORS = ("government", "education", "publishing", "docs", "commerce", "news", "webapp")
#: What readers are told about where a name comes from, and about an alternative that is not there.
SOURCE_LABELS = {
    "alt": "the image's alt attribute",
    "aria-label": "an aria-label",
    "aria-labelledby": "an aria-labelledby reference",
    "title": "a title attribute",
    "svg-title": "a title inside the SVG",
    "control-text": "the link or button's own text",
}
OTHER_SOURCE = "text in the markup"
NO_ALT, EMPTY_ALT = "(no alt attribute on the image)", '(alt="", deliberately empty)'


@dataclass(frozen=True)
class Settings:
    goal: int = 250
    add: int = 60
    batch_size: int = 30
    pages_per_host: int = 12
    follow: int = 8
    max_redirects: int = 5
    page_bytes: int = 4 * 1024 * 1024
    host_delay_s: float = 1.0
    shortlist_times: int = 5
    shortlist_headroom: int = 3
    per_page: int = 2
    domain_share: float = 0.05
    sector_min_share: float = 0.08
    sector_max_share: float = 0.25
    subtype_min_share: float = 0.05

    def domain_cap(self, headroom: int = 1) -> int:
        return max(1, ceil(round(self.goal * self.domain_share * headroom, 9)))

    def share(self, share: float) -> int:
        """Half rounds up."""
        return max(1, floor(round(self.goal * share, 9) + 0.5))
