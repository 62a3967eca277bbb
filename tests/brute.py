"""Plain-Python versions of the reports, for property tests on small inputs."""

from __future__ import annotations

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

CAUSES = [
    ("carrier_delay", "Carrier_Delay"),
    ("weather_delay", "Weather_Delay"),
    ("nas_delay", "NAS_Delay"),
    ("security_delay", "Security_Delay"),
    ("late_aircraft_delay", "Late_Aircraft_Delay"),
]


def r2(x):
    if x is None:
        return None
    d = Decimal(repr(x)).quantize(Decimal("0.000001"), ROUND_HALF_UP)
    return float(d.quantize(Decimal("0.01"), ROUND_HALF_UP))


def tier(r):
    if (r["cancelled"] or 0) == 1:
        return "CANCELLED"
    d = r["dep_delay"]
    if d is None:
        return None
    if 0 < d < 15:
        return "low"
    if 15 <= d <= 60:
        return "medium"
    if d > 60:
        return "high"
    return None


def causes_of(r):
    out = []
    code = r["cancellation_code"]
    if (r["cancelled"] or 0) == 1 and code not in (None, "N", ""):
        out.append("Cancellazione_" + code)
    for c, label in CAUSES:
        if r[c] is not None and r[c] > 0:
            out.append(label)
    return out


def delay_report(rows, k=3):
    groups = defaultdict(list)
    for r in rows:
        groups[(r["origin"], r["month"])].append(r)
    out = {}
    for key, rs in groups.items():
        vals = []
        for t in ("low", "medium", "high"):
            in_t = [r for r in rs if tier(r) == t]
            deps = [r["dep_delay"] for r in in_t]
            arrs = [r["arr_delay"] for r in in_t if r["arr_delay"] is not None]
            vals += [len(in_t), r2(sum(deps) / len(deps)) if deps else None, r2(sum(arrs) / len(arrs)) if arrs else None]
        counts = defaultdict(int)
        for r in rs:
            for c in causes_of(r):
                counts[c] += 1
        top = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:k]
        top += [(None, None)] * (k - len(top))
        for c, n in top:
            vals += [c, n]
        out[key] = tuple(vals)
    return out


def carrier_profile(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r["op_unique_carrier"], r["origin"])].append(r)
    out = {}
    for key, rs in groups.items():
        delays = [r["arr_delay"] for r in rs if r["arr_delay"] is not None]
        cancelled = sum((r["cancelled"] or 0) for r in rs)
        months = sorted({str(r["month"]) for r in rs if r["month"] is not None})
        out[key] = (
            len(rs),
            min(delays) if delays else None,
            max(delays) if delays else None,
            r2(sum(delays) / len(delays)) if delays else None,
            r2(float(cancelled) * 100 / len(rs)),
            "-".join(months),
        )
    return out
