"""Where documents, changes, control rows and configuration come from."""
