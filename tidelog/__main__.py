"""``python -m tidelog``."""

import sys

from .cli import main

sys.exit(main())
