import sys

from eventmart.cli import main

sys.exit(main())
