"""docflow: document changelogs, typed views and corpus jobs as Spark DataFrame plans."""
