"""Session, pipeline runner, job wrappers and the query registry."""
