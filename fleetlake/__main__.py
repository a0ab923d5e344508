"""``python -m fleetlake ...`` runs the command line (see fleetlake/cli.py)."""

import sys

from fleetlake.cli import main

sys.exit(main())
