"""spark-submit launcher for the star-schema build (see ``starmart/__main__.py``).

    spark-submit --py-files starmart.zip scripts/build_star.py --arrivals ... --out ...
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starmart.__main__ import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(main())
