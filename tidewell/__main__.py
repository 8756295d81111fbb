import sys

from tidewell.plans.cli import main

sys.exit(main())
