"""Session settings, fixed policy values, the derived test view and the registered queries."""
