"""Entry script for spark-submit: ``run_job.py {carrier_profile|delay_report|prepare} IN OUT [options]``."""

from punctuality.plans.jobs import main

if __name__ == "__main__":
    main()
