"""spark-submit entry point: ``spark-submit scripts/submit.py load config.yml ...``.

Executors need nothing from this package (the one Python task function is
shipped by value); only the driver imports it.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablepipe.__main__ import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(main())
