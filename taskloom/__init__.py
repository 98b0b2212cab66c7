"""taskloom: software-engineering task data as Spark dataflows."""
