import sys

from weftlink.plans.cli import main

sys.exit(main())
