import sys

from conformkit.cli import main

sys.exit(main())
