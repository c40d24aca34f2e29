"""Plans that put operators together: the conversion of scenarios."""
