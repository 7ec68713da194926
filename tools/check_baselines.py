"""Do both plans of every baseline case give the same rows?

    python tools/check_baselines.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import local_session  # noqa: E402
from tools.baselines import CASES  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, wrong = local_session(), 0
    for name, case in CASES.items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        i = case.stored(spark, sf)
        ours = case.ours(i)
        a, b = (sorted(map(str, df.select(*ours.columns).collect())) for df in (ours, case.plain(i)))
        wrong += a != b
        print("same " if a == b else "OTHER", name, len(a), len(b), "" if a == b else (a[:2], b[:2]), flush=True)
    sys.exit(wrong)


if __name__ == "__main__":
    main()
