"""File-list filter specification (FLT-17, FLT-18) and its normalisation from request-like input.

A ``ListSpec`` is a small frozen value built on the driver; ``operators.catalog.list_files``
turns it into ``where`` clauses that Catalyst pushes into the scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Any, Iterable, Mapping

from .. import schemas as S

TRUTHY = ("1", "true", "yes", "on")
FALSY = ("0", "false", "no", "off")
SORTABLE = ("filename", "catalog", "state", "year", "month", "segment", "overall_status", "updated_at", "created_at")


def truthy(value: Any) -> bool:
    """Truthy words (also JSON booleans and the number 1)."""
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return value == 1
    if isinstance(value, str):
        return value.strip().lower() in TRUTHY
    return False


def _tri_state(value: Any) -> bool | None:
    if isinstance(value, bool):
        return value
    if isinstance(value, str):
        v = value.strip().lower()
        if v in TRUTHY:
            return True
        if v in FALSY:
            return False
    return None


def _split_codes(items: Iterable[str], upper: bool = True) -> tuple[str, ...]:
    out = []
    for item in items:
        for part in str(item).split(","):
            v = part.strip()
            v = v.upper() if upper else v.lower()
            if v:
                out.append(v)
    return tuple(out)


def _atoi(value: Any) -> int | None:
    if value is None or value == "":
        return None
    try:
        return int(str(value).strip())
    except ValueError:
        return 0  # the pipeline ignores the parse error and keeps zero


@dataclass(frozen=True)
class ListSpec:
    catalog: str = ""
    catalogs: tuple[str, ...] = ()
    state: str = ""
    states: tuple[str, ...] = ()
    year: int | None = None
    month: int | None = None
    period_from: tuple[int, int] | None = None
    period_to: tuple[int, int] | None = None
    ftp_dir: str = ""
    filename: str = ""
    segment: str | None = None
    has_segment: bool | None = None
    status: str = ""
    statuses: tuple[str, ...] = ()
    policy_match: str = ""
    pipeline_completed: bool = False
    require: tuple[bool, bool, bool] = (True, True, True)
    sort_by: str = ""
    sort_dir: str = "desc"
    limit: int = S.LIST_DEFAULT_LIMIT
    offset: int = 0
    extra: Mapping[str, Any] = field(default_factory=dict)

    def with_page(self, limit: int, offset: int = 0) -> "ListSpec":
        return replace(self, limit=limit, offset=offset)

    def has_catalog_or_period(self) -> bool:
        return bool(self.catalog or self.catalogs or self.period_from or self.period_to)


def clamp_limit(limit: int | None) -> int:
    if limit is None:
        return S.LIST_DEFAULT_LIMIT
    return max(1, min(S.LIST_MAX_LIMIT, int(limit)))


def from_query(q: Mapping[str, Any], require: tuple[bool, bool, bool] = (True, True, True)) -> ListSpec:
    """Normalise URL-query style input (values may be lists) into a ``ListSpec``."""

    def first(key: str) -> str:
        v = q.get(key)
        if isinstance(v, (list, tuple)):
            return str(v[0]) if v else ""
        return "" if v is None else str(v)

    def many(key: str) -> list[str]:
        v = q.get(key)
        if v is None:
            return []
        return [str(x) for x in v] if isinstance(v, (list, tuple)) else [str(v)]

    limit_raw = first("limit")
    try:
        limit = int(limit_raw) if limit_raw else S.LIST_DEFAULT_LIMIT
    except ValueError:
        limit = S.LIST_DEFAULT_LIMIT
    try:
        offset = max(0, int(first("offset"))) if first("offset") else 0
    except ValueError:
        offset = 0
    seg = first("segment").strip()
    fy, fm, ty, tm = (_atoi(first(k)) for k in ("period_from_year", "period_from_month", "period_to_year", "period_to_month"))
    pm = first("policy_match").strip().lower()
    status = first("status")
    return ListSpec(
        catalog=first("catalog").strip().upper(),
        catalogs=_split_codes(many("catalog")),
        state=first("state").strip().upper(),
        states=_split_codes(many("state")),
        year=_atoi(first("year")),
        month=_atoi(first("month")),
        period_from=(fy, fm) if fy is not None and fm is not None else None,
        period_to=(ty, tm) if ty is not None and tm is not None else None,
        ftp_dir=first("ftp_dir"),
        filename=first("filename"),
        segment=seg.upper() if len(seg) == 1 else None,
        has_segment=_tri_state(first("has_segment")) if first("has_segment").strip() else None,
        status=status.strip().lower() if status else "",
        statuses=_split_codes(many("status"), upper=False),
        policy_match=pm if pm in ("pending", "ignored") else "",
        pipeline_completed=truthy(first("pipeline_completed")),
        require=require,
        sort_by=first("sort_by"),
        sort_dir=first("sort_dir") or "desc",
        limit=clamp_limit(limit),
        offset=offset,
    )


def from_filters_map(m: Mapping[str, Any] | None, require: tuple[bool, bool, bool] = (True, True, True)) -> ListSpec:
    """Normalise a JSON filter object (batch actions). Reads a superset of the batch keys."""
    m = m or {}

    def s(key: str) -> str | None:
        v = m.get(key)
        return v if isinstance(v, str) else None

    def as_int(key: str) -> int | None:
        v = m.get(key)
        if isinstance(v, bool):
            return None
        if isinstance(v, (int, float)):
            return int(v)
        return None

    seg = (s("segment") or "").strip().upper()
    has_seg = m.get("has_segment")
    fy, fm, ty, tm = (as_int(k) for k in ("period_from_year", "period_from_month", "period_to_year", "period_to_month"))
    pm = (s("policy_match") or "").strip().lower()
    cats = m.get("catalogs") if isinstance(m.get("catalogs"), list) else []
    sts = m.get("statuses") if isinstance(m.get("statuses"), list) else []
    return ListSpec(
        catalog=(s("catalog") or "").strip().upper(),
        catalogs=tuple(c.strip().upper() for c in cats if isinstance(c, str) and c.strip()),
        state=(s("state") or "").strip().upper(),
        filename=s("filename") or "",
        segment=seg if len(seg) == 1 else None,
        has_segment=has_seg if isinstance(has_seg, bool) else _tri_state(has_seg),
        ftp_dir=s("ftp_dir") or "",
        statuses=tuple(x.strip().lower() for x in sts if isinstance(x, str) and x.strip()),
        status=(s("status") or "").strip().lower(),
        period_from=(fy, fm) if fy is not None and fm is not None else None,
        period_to=(ty, tm) if ty is not None and tm is not None else None,
        sort_by=s("sort_by") or "",
        sort_dir=s("sort_dir") or "desc",
        policy_match=pm if pm in ("pending", "ignored") else "",
        pipeline_completed=truthy(m.get("pipeline_completed")),
        require=require,
    )


def has_catalog_or_period_filters(m: Mapping[str, Any] | None) -> bool:
    """FLT-18: a batch filter must name a catalog or a period bound."""
    if not m:
        return False

    def nonblank(v: Any) -> bool:
        return isinstance(v, str) and v.strip() != ""

    if nonblank(m.get("catalog")):
        return True
    cats = m.get("catalogs")
    if isinstance(cats, list) and any(nonblank(c) for c in cats):
        return True
    return any(
        isinstance(m.get(k), (int, float)) and not isinstance(m.get(k), bool)
        for k in ("period_from_year", "period_from_month", "period_to_year", "period_to_month")
    )


def require_catalog_or_period(m: Mapping[str, Any] | None) -> None:
    if not has_catalog_or_period_filters(m):
        raise ValueError("filters must include catalog and/or period criteria")


def normalize_list_col(c, upper: bool = True):
    """FLT-17 on columns: comma split, trim, upper (or lower) case, blanks dropped."""
    from pyspark.sql import functions as F

    col = F.col(c) if isinstance(c, str) else c
    case = F.upper if upper else F.lower
    return F.filter(F.transform(F.split(col, ","), lambda x: case(F.trim(x))), lambda x: x != "")
