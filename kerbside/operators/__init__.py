"""DataFrame operators: harmonisation, marts, profiles, insights, features, forecast."""
