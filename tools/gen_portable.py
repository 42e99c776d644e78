"""Regenerate tallyframe/plans/catalog/portable_spec.py from the live query schemas.

    python tools/gen_portable.py
"""

from __future__ import annotations

import os
import pprint
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    from tallyframe.plans import catalog
    from tallyframe.plans.catalog.portable import kinds
    from tallyframe.session import local_session

    spark = local_session(2)
    spec = {name: kinds(fn(spark, "/root/testdata/sf0.001").schema) for name, fn in sorted(catalog.QUERIES.items())}
    path = os.path.join(ROOT, "tallyframe", "plans", "catalog", "portable_spec.py")
    with open(path, "w") as f:
        f.write('"""Column kinds of every registered query (generated by tools/gen_portable.py)."""\n\n')
        f.write("SPEC = " + pprint.pformat(spec, width=110, sort_dicts=True) + "\n")
    print(f"wrote {len(spec)} queries to {path}")


if __name__ == "__main__":
    main()
