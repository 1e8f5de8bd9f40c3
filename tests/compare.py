"""Result comparison: same columns, same rows whatever their order."""

from __future__ import annotations

import math
from collections import Counter


def _value(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 4)
    if isinstance(v, int):
        return round(float(v), 4)
    return str(v)


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_value(r[i]) for i in order) for r in rows)


def differences(spark_df, relation, limit=5):
    """Text describing how the two results differ, '' when they agree."""
    left = normalised(spark_df.columns, spark_df.collect())
    right = normalised(relation.columns, relation.fetchall())
    if left[0] != right[0]:
        return f"columns differ: {set(left[0]) ^ set(right[0])}"
    only_left, only_right = left[1] - right[1], right[1] - left[1]
    if not only_left and not only_right:
        return ""
    return (
        f"{sum(left[1].values())} vs {sum(right[1].values())} rows; {left[0]}\n"
        f"  only spark ({sum(only_left.values())}): {list(only_left)[:limit]}\n"
        f"  only sql ({sum(only_right.values())}): {list(only_right)[:limit]}"
    )
