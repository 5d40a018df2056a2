"""Names, paths, URLs and timestamps as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the annotation tool's URL forms.
LOCAL_FILES_PREFIX = "/data/local-files/?d="
LOCAL_FILES_MARKER = "/data/local-files/"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def capture_stem(ts, cat_count, kind, camera_id=None) -> Column:
    """``yyyyMMdd_HHmmss_SSS`` (ms truncated) + ``_{n}cats`` / ``_background``.

    At fleet scale two cameras can save within one millisecond, so a camera
    prefix is added when ``camera_id`` is given."""
    stamp = F.date_format(_c(ts), "yyyyMMdd_HHmmss_SSS")
    suffix = F.when(_c(kind) == "cats", F.concat(F.lit("_"), _c(cat_count).cast("string"), F.lit("cats"))) \
              .otherwise(F.lit("_background"))
    stem = F.concat(stamp, suffix)
    if camera_id is not None:
        stem = F.concat(_c(camera_id).cast("string"), F.lit("_"), stem)
    return stem


def iso_timestamp(ts) -> Column:
    """Python ``datetime.isoformat()``: fraction only when microseconds ≠ 0."""
    t = _c(ts)
    base = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.unix_micros(t) % 1000000 == 0, base) \
            .otherwise(F.concat(base, F.lit("."), F.date_format(t, "SSSSSS")))


def file_name(path) -> Column:
    """Last path component after collapsing trailing ``/`` and ``/.``
    (the regex only runs for the rare paths that end that way)."""
    p = _c(path)
    odd = p.endswith("/") | p.endswith("/.")
    p = F.when(odd, F.regexp_replace(p, r"(/+\.?)+$", "")).otherwise(p)
    return F.substring_index(p, "/", -1)


def file_stem(path) -> Column:
    """Name without its last suffix; dot-files and trailing-dot names unchanged
    (Python ``PurePath.stem``: the last dot must be neither first nor last)."""
    n = file_name(path)
    back = F.instr(F.reverse(n), ".")                  # 1-based from the end, 0 = no dot
    last_dot = F.length(n) - back + 1
    return F.when((back > 1) & (last_dot > 1), n.substr(F.lit(1), last_dot - 1)).otherwise(n)


def image_filename(url) -> Column:
    """Filename used as the merge/skip key.

    Text after the last ``?d=`` when present, else the whole URL; then the last
    path component.  Empty/NULL URL → NULL.  No percent-decoding."""
    u = _c(url)
    tail = F.when(F.instr(u, "?d=") > 0, F.substring_index(u, "?d=", -1)).otherwise(u)
    return F.when(u.isNull() | (u == ""), F.lit(None).cast("string")).otherwise(file_name(tail))


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _join_root(root: str, rel: Column) -> Column:
    """``str(Path(root) / rel)``: an absolute ``rel`` replaces the root; then
    collapse ``//``, drop ``.`` components and trailing ``/``; empty → ``.``."""
    under = F.lit(root.rstrip("/") + "/")
    return once(rel, lambda r: once(F.when(r.startswith("/"), r).otherwise(F.concat(under, r)), _normal_path))


def _normal_path(joined: Column) -> Column:
    s = F.regexp_replace(joined, r"/{2,}", "/")
    s = F.regexp_replace(s, r"/(\./)+", "/")
    s = F.regexp_replace(s, r"^(\./)+", "")
    s = F.regexp_replace(s, r"(?<=.)/\.?$", "")
    # single use of ``s`` keeps the regex chain inside the guarded branch
    norm = F.regexp_replace(s, r"^\.?$", ".")
    # the regexes only run for paths that need them
    odd = (F.instr(joined, "//") > 0) | (F.instr(joined, "/./") > 0) | joined.startswith("./") \
        | joined.endswith("/") | joined.endswith("/.") | (joined == "") | (joined == ".")
    return F.when(odd, norm).otherwise(joined)


# query string (after the first '?', before any fragment), then its first non-empty d
_QUERY = r"^[^?#]*\?([^#]*)"
_D_PARAM = r"(?:^|&)d=([^&]+)"
# path of scheme://netloc/path?query#fragment, leading slashes dropped (linear, no backtracking)
_HTTP_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?/*([^?#]*)"


def image_path(url, document_root: str = ".") -> Column:
    """Filesystem path of a task image.

    Local-files form: first non-empty ``d`` query parameter, percent-decoded
    (``+`` is a space).  HTTP form: the URL path without query, fragment or
    ``;params``, leading ``/`` stripped, not decoded."""
    u = _c(url)
    d_raw = F.regexp_extract(F.regexp_extract(u, _QUERY, 1), _D_PARAM, 1)
    # an escape that is none stays as it is written
    local_rel = once(d_raw, lambda d: F.coalesce(F.try_url_decode(d), F.try_url_decode(
        F.regexp_replace(d, r"%(?![0-9A-Fa-f]{2})", "%25")), d))
    path = F.regexp_extract(u, _HTTP_PATH, 1)
    # ';params' belong to the last segment only
    http_rel = once(path, lambda p: F.when(F.instr(p, ";") > 0, F.regexp_replace(p, r";[^/]*$", "")).otherwise(p))
    rel = F.when(F.instr(u, LOCAL_FILES_MARKER) > 0, local_rel).otherwise(http_rel)
    return _join_root(document_root, rel)


def image_url(path, document_root: str, base_url: str = "") -> Column:
    """Task URL of an absolute normalised image path.

    Path outside ``document_root`` → NULL (callers route it to warnings)."""
    p = _c(path)
    root = document_root.rstrip("/") + "/" if document_root != "/" else "/"
    rel = F.when(p.startswith(root), F.substring(p, len(root) + 1, 1 << 30))
    if base_url:
        return F.concat(F.lit(base_url.rstrip("/") + "/"), rel)
    return F.concat(F.lit(LOCAL_FILES_PREFIX), rel)
