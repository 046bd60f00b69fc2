import sys

from terrace.pipeline import main

sys.exit(main())
