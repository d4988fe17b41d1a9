"""SQL counterparts of the step-by-step operators, one block of common tables a step."""

from __future__ import annotations


def steps(windows: str, near: str, budget: int, alpha: float, most: int) -> str:
    """Greedy coverage unrolled to ``most`` picks."""
    out = [
        f"c AS MATERIALIZED (SELECT * FROM {windows})",
        f"near AS MATERIALIZED (SELECT * FROM {near})",
        """m AS MATERIALIZED (SELECT c.ord, CAST(((gz + z.v) * 10 + gy + y.v) * 10 + gx + x.v AS BIGINT) AS patch_id
  FROM c, range(2) z(v), range(2) y(v), range(2) x(v) WHERE z.v < wz AND y.v < wy AND x.v < wx)""",
        "cover AS MATERIALIZED (SELECT DISTINCT m.ord, near.neighbour AS p FROM m JOIN near ON near.id = m.patch_id)",
    ]
    before: list[str] = []
    for i in range(1, most + 1):
        done = " UNION ALL ".join(f"SELECT ord, cost FROM p{j}" for j in range(1, i)) or "SELECT 0 AS ord, 0 AS cost WHERE false"
        out.append(f"done{i} AS MATERIALIZED ({done})")
        out.append(f"""p{i} AS MATERIALIZED (SELECT {i} AS rank, g.ord, g.gain, c.cost FROM (
    SELECT ord, count(*) AS gain FROM cover WHERE p NOT IN (SELECT p FROM cover WHERE ord IN (SELECT ord FROM done{i})) GROUP BY 1) g JOIN c USING (ord)
  WHERE g.ord NOT IN (SELECT m.ord FROM m WHERE patch_id IN (SELECT patch_id FROM m WHERE ord IN (SELECT ord FROM done{i})))
    AND c.cost + (SELECT coalesce(sum(cost), 0) FROM done{i}) <= {budget}
  ORDER BY g.gain / pow(c.cost::DOUBLE, {alpha}) DESC, g.gain DESC, c.cost, g.ord LIMIT 1)""")
        before.append(f"SELECT * FROM p{i}")
    return "WITH " + ",\n".join(out) + "\n" + " UNION ALL ".join(before)


def matches(pairs: str, threshold: float, most: int) -> str:
    """Greedy matching unrolled to ``most`` pairs."""
    out = [f"q AS MATERIALIZED (SELECT pred, truth, n, iou FROM {pairs} WHERE iou >= {threshold})"]
    for i in range(1, most + 1):
        done = " UNION ALL ".join(f"SELECT pred, truth FROM m{j}" for j in range(1, i)) or "SELECT 0 AS pred, 0 AS truth WHERE false"
        out.append(f"""m{i} AS MATERIALIZED (SELECT * FROM q WHERE pred NOT IN (SELECT pred FROM ({done})) AND truth NOT IN (SELECT truth FROM ({done}))
  ORDER BY iou DESC, pred DESC, truth DESC LIMIT 1)""")
    return "WITH " + ",\n".join(out) + "\n" + " UNION ALL ".join(f"SELECT * FROM m{i}" for i in range(1, most + 1))
