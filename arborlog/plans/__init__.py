"""Training, search and whole jobs: plans that run several Spark jobs and keep only model-sized rows on the driver."""
