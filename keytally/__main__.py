"""``python -m keytally <job> ...`` — see :mod:`keytally.cli`."""

import sys

from keytally.cli import run

sys.exit(run())
