"""The three data flows: forecast archive, observation archive, verification."""
