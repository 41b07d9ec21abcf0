"""Queries of the general operators for training data: attribute history and snapshot changes."""

from __future__ import annotations

from pageatlas.operators.history import attribute_history
from pageatlas.operators.snapshots import changes_between_days
from pageatlas.session import table


def p1_found(spark, sf_dir):
    history = attribute_history(table(spark, sf_dir, "people"), table(spark, sf_dir, "directory_snapshots"))
    return history.select("person_id", "url", "valid_from", "valid_to")


def p4_found(spark, sf_dir):
    return changes_between_days(table(spark, sf_dir, "directory_snapshots"))


QUERIES = {"p1_found": p1_found, "p4_found": p4_found}

ORACLES = {
    "p4_found": r"""
WITH days AS (
  SELECT snapshot_date AS day, max(coalesce(delivery, -1)) AS delivery,
         row_number() OVER (ORDER BY snapshot_date) AS no
  FROM directory_snapshots WHERE snapshot_date IS NOT NULL GROUP BY 1),
lines AS (
  SELECT d.no, d.day, regexp_replace(s.url, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS u,
         coalesce(s.line_no, 4611686018427387904) AS line_no,
         list_transform([s.name, s.city, s.state, s.country],
           lambda x: nfc_normalize(trim(regexp_replace(coalesce(x, ''), '[\s\p{Z}]+', ' ', 'g')))) AS attrs
  FROM directory_snapshots s JOIN days d
    ON s.snapshot_date = d.day AND coalesce(s.delivery, -1) = d.delivery),
recs AS (
  SELECT no, day, u, arg_min(attrs, line_no) AS attrs FROM lines
  WHERE regexp_matches(u, '^https?://') GROUP BY 1, 2, 3)
SELECT d.day AS snapshot_date, coalesce(c.u, p.u) AS url,
       CASE WHEN p.u IS NULL THEN 'added' WHEN c.u IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM (SELECT * FROM recs WHERE no > 1) c
FULL JOIN (SELECT no + 1 AS no, u, attrs FROM recs WHERE no < (SELECT max(no) FROM days)) p
  ON c.no = p.no AND c.u = p.u
JOIN days d ON d.no = coalesce(c.no, p.no)
WHERE p.u IS NULL OR c.u IS NULL OR p.attrs <> c.attrs
""",
}
