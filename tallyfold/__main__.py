"""Command line: run the three jobs on exported files.

  python -m tallyfold legacy   --places P --legacy-wide W --out DIR [--rules field]
  python -m tallyfold regional --submissions S --places P [--exclusions E] --out DIR [--rules field]
  python -m tallyfold local    --classified DIR/classified --decisions D --attendance A
                               --legacy DIR/legacy_long --places P --out DIR [--rules field]

Inputs are CSV, JSON or Parquet, picked by extension.  Columns are found by the
original headers of the rule set (or by the declared names of
``tallyfold.sources.schemas``); a banner above a CSV header is left out, and the
legacy sheet's columns count by position.  Rows that can't be read are written to
``DIR/rejects_<input>``.  Set ``spark.checkpoint.dir`` to a shared folder when
running on a cluster; a job removes its own intermediate tables.
"""

from __future__ import annotations

import argparse
import json

from tallyfold.plans import rules as R
from tallyfold.plans import workflow
from tallyfold.session import build_session, scratch_run
from tallyfold.sources import schemas
from tallyfold.sources.io import read_input


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tallyfold", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("job", choices=["legacy", "regional", "local"])
    ap.add_argument("--rules", choices=["field", "standin"], default="field")
    ap.add_argument("--master", default=None)
    for name in ("submissions", "places", "exclusions", "legacy-wide", "classified",
                 "decisions", "attendance", "legacy", "out"):
        ap.add_argument(f"--{name}")
    ap.add_argument("--decision-column", default=None,
                    help="column of the edited candidate file holding the verdict")
    a = ap.parse_args(argv)
    rules = R.FIELD if a.rules == "field" else R.STANDIN
    spark = build_session(a.master)

    def read(kind: str, path: str, schema, **places):
        headers = dict(rules.headers.get(kind, {}))
        if kind == "decisions" and a.decision_column:
            headers["decision"] = a.decision_column
        return read_input(spark, path, schema, headers, rejects=f"{a.out}/rejects_{kind}",
                          positions=rules.positions.get(kind), patterns=rules.patterns.get(kind), **places)

    with scratch_run(spark):
        places = read("places", a.places, schemas.GAZETTEER)
        if a.job == "legacy":
            tail = list(rules.legacy_tail) if rules.legacy_tail else None
            workflow.legacy_job(places, read("legacy_wide", a.legacy_wide, schemas.LEGACY_WIDE, tail=tail),
                                a.out, rules)
            out = {"legacy_long": f"{a.out}/legacy_long"}
        elif a.job == "regional":
            excl = read("exclusions", a.exclusions, schemas.EXCLUSIONS) if a.exclusions else None
            # the form has no id of its own: rows of the same stamp keep their order
            subs = read("submissions", a.submissions, schemas.SUBMISSIONS, row_id="submission_id")
            out = workflow.regional_job(subs, excl, places, a.out, rules)
        else:
            out = workflow.local_job(spark, a.classified, read("decisions", a.decisions, schemas.DECISIONS),
                                     read("attendance", a.attendance, schemas.ATTENDANCE),
                                     a.legacy, places, a.out, rules)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
