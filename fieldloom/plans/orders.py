"""Shuffled orders for several readers."""

from pyspark.sql import functions as F

from ..operators import sampling as S
from .tables import events

_WORLD, _SEED = 3, "s"


def _strided(s, d):
    rows = events(s, d).where("event_id % 7 > 0").select("event_id")
    both = [S.strided(rows, ["event_id"], _WORLD, epoch, _SEED).withColumn("epoch", F.lit(epoch)) for epoch in (0, 2)]
    return both[0].unionByName(both[1]).select("event_id", "epoch", "place", "reader", "step")


def _strided_sql(epoch: int) -> str:
    """The rounds of one pass over the two halves, and as many passes as bring all numbers back."""
    mix = lambda k, x: f"('0x' || substr(md5('{_SEED}:{epoch}:{k}:' || {x}), 1, 8))::BIGINT"
    parts = [f"i0_{epoch} AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS x, n, a, (n + a - 1) // a AS b FROM rows, sides)"]
    for walk in range(6):
        parts.append(f"w{walk}_0_{epoch} AS (SELECT * EXCLUDE (x), x AS was, x % a AS l, x // a AS r FROM i{walk}_{epoch})")
        for k in range(2 * S.ROUNDS):
            moved = f"(l + {mix(k, 'r')}) % a AS l, r" if k % 2 == 0 else f"l, (r + {mix(k, 'l')}) % b AS r"
            parts.append(f"w{walk}_{k + 1}_{epoch} AS (SELECT * EXCLUDE (l, r), {moved} FROM w{walk}_{k}_{epoch})")
        again = "true" if walk == 0 else "was >= n"
        parts.append(f"i{walk + 1}_{epoch} AS (SELECT * EXCLUDE (was, l, r), CASE WHEN {again} THEN r * a + l ELSE was END AS x FROM w{walk}_{2 * S.ROUNDS}_{epoch})")
    return ",\n".join(parts)


def _places(epoch: int) -> str:
    return f"SELECT event_id, {epoch} AS epoch, x + {epoch} * n AS place, CAST((x + {epoch} * n) % {_WORLD} AS INTEGER) AS reader, (x + {epoch} * n) // {_WORLD} AS step FROM i6_{epoch}"


QUERIES = {
    "strided_shuffle": (
        _strided,
        f"""WITH rows AS (SELECT event_id FROM events WHERE event_id % 7 > 0), sides AS (SELECT count(*) AS n, CAST(floor(sqrt(count(*) - 1)) AS BIGINT) + 1 AS a FROM rows),
{_strided_sql(0)},
{_strided_sql(2)}
{_places(0)} UNION ALL {_places(2)}""",
    ),
}
