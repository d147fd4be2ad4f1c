import sys

from poolspark.cli import main

sys.exit(main())
