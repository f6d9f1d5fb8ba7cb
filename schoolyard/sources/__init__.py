"""Where raw tables come from and where results go."""
