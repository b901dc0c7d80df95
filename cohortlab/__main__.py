"""``python -m cohortlab TRAIN TEST OUT [...]`` runs the batch job."""

import sys

from cohortlab.plans.job import main

sys.exit(main())
