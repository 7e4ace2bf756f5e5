import sys

from cohortlens.cli import main

sys.exit(main())
