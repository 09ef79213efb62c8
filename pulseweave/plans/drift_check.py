"""Drift detection as recursive SQL, to check the registered drift queries.

Every recursion step moves each series on by one small action, chosen by
``phase``: 0 takes the next reading in, 1 merges the two oldest buckets of an
overfull row, 2 looks for a cut, 3 drops one old bucket.  ``rows[i]`` lists the
buckets of 2^(i-1) readings, oldest first.
"""

from __future__ import annotations

_TOP = "rows[len(rows)]"
_SIZE = "CAST(power(2, len(rows) - 1) AS BIGINT)"
_AFTER = "CASE WHEN {width} > 16 THEN 2 ELSE 0 END"

# Sensitivity after a reading whose distance to the one before is known.
_LEVEL = ("3e-1 * (abs(n.value - rows[1][-1].s) / (greatest(high, n.value) - least(low, n.value)))"
          " + 7e-1 * relative")

# Is there a cut after the first k buckets of the oldest row?
_CUT = """
    CASE WHEN k * size < 5 OR width - k * size < 5 THEN FALSE
         WHEN NOT (2e0 * (1e0 / (k * size - 4e0) + 1e0 / (width - k * size - 4e0))
                   * spread * lt >= 0) THEN FALSE
         ELSE abs(list_reduce([CAST(0 AS DOUBLE)] || sums[1:k], lambda a, b: a + b) / (k * size)
                  - list_reduce([total] || sums[1:k], lambda a, b: a - b) / (width - k * size))
              > (sqrt(2e0 * (1e0 / (k * size - 4e0) + 1e0 / (width - k * size - 4e0))
                      * spread * lt)
                 + 2e0 / 3e0 * lt * (1e0 / (k * size - 4e0) + 1e0 / (width - k * size - 4e0)))
                * ratio
    END"""


def walk(source: str, adaptive: bool) -> str:
    """Steps of all series of ``source`` (patient_id, rn, us, value)."""
    tuned = f"{str(adaptive).upper()} AND len(rows[1]) > 0 AND " \
            "greatest(high, n.value) > least(low, n.value)"
    middle = "level > 15e-2 AND level < 4e-1"
    return f"""
    SELECT patient_id, CAST(0 AS BIGINT) AS rn, 0 AS phase, CAST(0 AS BIGINT) AS width,
           CAST(0 AS DOUBLE) AS total, CAST(0 AS DOUBLE) AS variance, 3e-1 AS delta,
           1e0 AS ratio, CAST(0 AS DOUBLE) AS relative, 5e-324 AS high,
           CAST('infinity' AS DOUBLE) AS low,
           CAST([[]] AS STRUCT(s DOUBLE, v DOUBLE, t BIGINT)[][]) AS rows,
           CAST(1 AS BIGINT) AS row_no, CAST(0 AS BIGINT) AS todo, FALSE AS cut,
           CAST(0 AS DOUBLE) AS value
    FROM (SELECT DISTINCT patient_id FROM {source}) AS p
    UNION ALL
    SELECT patient_id, new_rn,
        CASE phase
            WHEN 0 THEN CASE WHEN len(new_rows[1]) > 5 THEN 1
                             ELSE {_AFTER.format(width="new_width")} END
            WHEN 1 THEN CASE WHEN len(new_rows[row_no + 1]) > 5 THEN 1
                             ELSE {_AFTER.format(width="width")} END
            WHEN 2 THEN CASE WHEN drop_n > 0 THEN 3 ELSE 0 END
            ELSE CASE WHEN todo > 1 THEN 3 ELSE 2 END END,
        new_width, new_total,
        CASE phase
            WHEN 0 THEN CASE WHEN width > 0
                THEN variance + width / CAST(new_width AS DOUBLE) * (next_value - total / width)
                     * (next_value - total / width) ELSE variance END
            WHEN 3 THEN variance - (oldest.v + CAST(size * new_width AS DOUBLE)
                     * (oldest.s / size - new_total / new_width)
                     * (oldest.s / size - new_total / new_width)) / (size + new_width)
            ELSE variance END,
        CASE WHEN level IS NOT NULL AND {middle}
             THEN least(CASE WHEN jump < 4e-1 THEN 8e-1 ELSE 6e-1 END,
                        3e-1 + (level - 8e-2) * 3) ELSE delta END,
        CASE WHEN level IS NOT NULL AND {middle}
             THEN CASE WHEN jump < 4e-1 THEN greatest(35e-2, 1e0 - level * 35e-1)
                       ELSE greatest(5e-1, 1e0 - level * 25e-1) END ELSE ratio END,
        CASE WHEN level IS NULL THEN relative
             WHEN {middle} THEN CASE WHEN jump < 4e-1 THEN level ELSE level - 15e-3 END
             WHEN level >= 4e-1 THEN level - 1e-1 ELSE level END,
        CASE WHEN phase = 0 THEN greatest(high, next_value) ELSE high END,
        CASE WHEN phase = 0 THEN least(low, next_value) ELSE low END,
        new_rows,
        CASE phase WHEN 0 THEN 1 WHEN 1 THEN row_no + 1 ELSE row_no END,
        CASE phase WHEN 2 THEN drop_n WHEN 3 THEN todo - 1 ELSE todo END,
        CASE phase WHEN 0 THEN FALSE WHEN 2 THEN cut OR drop_n > 0 ELSE cut END,
        CASE WHEN phase = 0 THEN next_value ELSE value END
    FROM (
        SELECT w.*, n.value AS next_value, {_SIZE} AS size, {_TOP}[1] AS oldest,
            CASE WHEN phase = 0 THEN w.rn + 1 ELSE w.rn END AS new_rn,
            CASE WHEN phase = 0 AND {tuned} THEN {_LEVEL} END AS level,
            CASE WHEN phase = 0 AND {tuned} THEN abs(n.value - rows[1][-1].s) END AS jump,
            CASE phase WHEN 0 THEN width + 1 WHEN 3 THEN width - {_SIZE} ELSE width END
                AS new_width,
            CASE phase WHEN 0 THEN total + n.value WHEN 3 THEN total - {_TOP}[1].s
                       ELSE total END AS new_total,
            CASE phase
                WHEN 0 THEN [list_append(rows[1], {{'s': n.value, 'v': CAST(0 AS DOUBLE),
                                                    't': n.us}})] || rows[2:]
                WHEN 1 THEN rows[1:row_no - 1] || [rows[row_no][3:]] || [list_append(
                    coalesce(rows[row_no + 1], []),
                    {{'s': rows[row_no][1].s + rows[row_no][2].s,
                      'v': rows[row_no][1].v + rows[row_no][2].v
                           + power(2, row_no - 1) * power(2, row_no - 1)
                           * (rows[row_no][1].s / power(2, row_no - 1)
                              - rows[row_no][2].s / power(2, row_no - 1))
                           * (rows[row_no][1].s / power(2, row_no - 1)
                              - rows[row_no][2].s / power(2, row_no - 1)) / power(2, row_no),
                      't': least(rows[row_no][1].t, rows[row_no][2].t)}})]
                    || rows[row_no + 2:]
                WHEN 3 THEN CASE WHEN len({_TOP}) = 1 THEN rows[1:len(rows) - 1]
                                 ELSE rows[1:len(rows) - 1] || [{_TOP}[2:]] END
                ELSE rows END AS new_rows,
            CASE WHEN phase = 2 AND len(rows) > 1 THEN coalesce(list_filter(
                list_transform(range(1, len({_TOP})), lambda k: CASE WHEN
                    {_CUT.replace("spread", "(variance / width)")
                         .replace("lt", "ln(2e0 * ln(width) / delta)")
                         .replace("sums", f"list_transform({_TOP}, lambda x: x.s)")
                         .replace("size", _SIZE)}
                    THEN k END), lambda k: k IS NOT NULL)[1], 0) ELSE 0 END AS drop_n
        FROM drift_walk w LEFT JOIN {source} n
            ON w.phase = 0 AND n.patient_id = w.patient_id AND n.rn = w.rn + 1
        WHERE w.phase > 0 OR n.rn IS NOT NULL) AS step"""
