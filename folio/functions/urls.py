"""URL rules."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Section path to class label.
SECTION_LABELS = {
    "economia": "economia",
    "el-pais": "elpais",
    "sociedad": "sociedad",
    "el-mundo": "elmundo",
}
ARTICLE_PATH = r"/20\d\d/\d{2}/\d{2}/.+"


def build_url(base: str, path: Column) -> Column:
    """Base plus path; a missing path leaves the bare base, so all such articles share a URL."""
    return F.concat(F.lit(base), F.coalesce(path, F.lit("")))


def _without_dots(url: Column) -> Column:
    """Remove . and .. segments; what climbs above the root stays at the root."""
    origin = F.regexp_extract(url, r"^(\w+://[^/?#]+)", 1)
    path = F.regexp_extract(url, r"^\w+://[^/?#]+/([^?#]*)", 1)
    tail = F.regexp_extract(url, r"([?#].*)$", 1)
    nothing = F.array().cast("array<string>")
    kept = F.aggregate(
        F.split(path, "/"),
        nothing,
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(part))),
    )
    ends_in_dots = F.when(path.rlike(r"(^|/)\.{1,2}$"), F.lit("/")).otherwise(F.lit(""))
    return F.concat(origin, F.lit("/"), F.array_join(kept, "/"), ends_in_dots, tail)


def resolve_url(page_url: Column, href: Column) -> Column:
    """Absolute form of a link found on a page."""
    origin = F.regexp_extract(page_url, r"^(\w+://[^/?#]+)", 1)
    scheme = F.regexp_extract(page_url, r"^(\w+:)", 1)
    bare = F.regexp_replace(page_url, r"[?#].*$", "")
    no_fragment = F.regexp_replace(page_url, r"#.*$", "")
    folder = F.concat(origin, F.lit("/"), F.regexp_extract(bare, r"^\w+://[^/]+/(.*/)", 1))
    joined = (
        F.when(href == "", page_url)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(href.startswith("#"), F.concat(no_fragment, href))
        .when(href.startswith("?"), F.concat(bare, href))
        .otherwise(F.concat(folder, href))
    )
    return F.when(joined.rlike(r"^\w+://[^?#]*/\.{1,2}(/|$|[?#])"), _without_dots(joined)).otherwise(joined)


def is_article_url(url: Column, host: str) -> Column:
    r"""URLs of the form host/20YY/MM/DD/rest; ``host`` is a regular expression."""
    return url.rlike(f"^{host}{ARTICLE_PATH}")


def url_slug(url: Column, suffix: str = ".html") -> Column:
    """Last path segment without trailing slashes, with the suffix added when absent."""
    last = F.element_at(F.split(F.rtrim(url, F.lit("/")), "/"), -1)
    return F.when(last.endswith(suffix), last).otherwise(F.concat(last, F.lit(suffix)))


def map_section(section: Column, labels: Mapping[str, str] = SECTION_LABELS) -> Column:
    """Class label of a section; null for sections that are not read."""
    pairs = [F.lit(part) for item in labels.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), section)
